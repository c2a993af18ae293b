"""A register of named queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable


class Register:
    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None, dates: tuple[str, ...] = ()) -> Callable:
        """Register the decorated function under its name, with its SQL if it has one.

        dates are given out as text on both sides, as clients read date columns differently.
        """

        def add(f: Callable) -> Callable:
            def run(spark, sf_dir: str):
                out = f(spark, sf_dir)
                return out.withColumns({d: out[d].cast("string") for d in dates})

            self.queries[f.__name__] = run if dates else f
            if sql is not None:
                shown = ", ".join(f"cast({d} as varchar) as {d}" for d in dates)
                self.sql[f.__name__] = f"select * replace ({shown}) from ({sql})" if dates else sql
            return f

        return add
