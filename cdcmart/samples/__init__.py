"""The operators applied to the star-schema sample tables: landing views, named queries and their SQL counterparts."""
