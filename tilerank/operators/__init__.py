"""operators"""
