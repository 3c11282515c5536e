"""phonoloom.functions"""
