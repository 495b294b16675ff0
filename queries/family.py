"""A group of registered queries, each with the SQL it is checked against if SQL can express it."""

from __future__ import annotations


class Family:
    def __init__(self):
        self.queries, self.oracles = {}, {}

    def query(self, name: str, sql: str | None = None):
        def register(function):
            self.queries[name] = function
            if sql:
                self.oracles[name] = sql
            return function
        return register
