"""gridloom.operators"""
