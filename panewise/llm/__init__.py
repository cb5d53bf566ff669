"""Training-data operators: ten operators on documents, pages and embeddings.

Nothing outside this package imports it. Operators take and return DataFrames;
``entries`` binds them to the registered queries.
"""
