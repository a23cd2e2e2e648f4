"""kitloom.plans"""
