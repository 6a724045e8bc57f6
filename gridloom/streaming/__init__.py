"""gridloom.streaming"""
