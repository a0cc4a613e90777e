"""scriptloom: turns large script, document and page collections into a queryable knowledge base on Spark."""
