"""gridloom.plans"""
