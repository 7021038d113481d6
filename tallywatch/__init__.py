"""Metric-trust engine on Spark: is a moving daily metric wrong data or real behaviour?"""
