"""kitloom.streaming"""
