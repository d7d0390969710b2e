"""Operators of a training-data pipeline over large text corpora; nothing else in the library imports this folder."""
