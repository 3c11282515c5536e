"""phonoloom.operators"""
