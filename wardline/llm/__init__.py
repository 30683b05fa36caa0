"""Operations of a training-data pipeline over documents, pages and embeddings.

Ten operators, one module each; nothing else in the library imports this
subpackage. ``queries.QUERIES`` holds their registered queries.
"""
