"""kitloom.functions"""
