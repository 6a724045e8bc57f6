"""gridloom.sources"""
