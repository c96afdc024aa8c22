"""Operators for training-data pipelines, one module per problem.

Nothing outside this package imports it; ``voxloom.llm.entries`` lists its queries.
"""
