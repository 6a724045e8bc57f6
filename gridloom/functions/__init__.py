"""gridloom.functions"""
