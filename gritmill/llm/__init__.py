"""Operators of a training-data pipeline: language, URLs, licences, scores, mixes, personal data, quality, neighbours, copies, leaks."""
