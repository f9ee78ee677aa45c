"""tidemark.streaming"""
