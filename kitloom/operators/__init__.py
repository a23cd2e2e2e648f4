"""kitloom.operators"""
