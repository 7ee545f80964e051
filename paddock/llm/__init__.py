"""Training-data operators: language ID, similarity joins, secret scans, mixing and the rest.

Nothing outside this folder imports it; ``paddock.llm.queries`` lists its queries.
"""
