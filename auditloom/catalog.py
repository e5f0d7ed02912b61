"""All queries by name, and their SQL."""

from auditloom.plans import authoring, documents, events, star, validation

_REGISTERS = (authoring.register, documents.register, events.register, star.register, validation.register)
QUERIES = {name: query for r in _REGISTERS for name, query in r.queries.items()}
SQL = {name: sql for r in _REGISTERS for name, sql in r.sql.items()}
