"""Marquee: curate nested catalogue extracts and answer questions over them with Spark."""
