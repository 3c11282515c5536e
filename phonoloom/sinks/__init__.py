"""phonoloom.sinks"""
