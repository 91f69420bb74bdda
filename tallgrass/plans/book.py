"""A list of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from .views import with_views


class Book:
    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.oracles: dict[str, str] = {}

    def add(self, sql: str | None = None) -> Callable:
        """Register a function (spark, sf_dir) under its name; the SQL may name the shared views."""

        def keep(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql:
                self.oracles[f.__name__] = with_views(sql)
            return f

        return keep
