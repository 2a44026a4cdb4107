"""Operators of a training-data pipeline: texts, chats, urls and near duplicates."""
