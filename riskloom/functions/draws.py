"""Random-looking column values made from one uniform draw or two."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from riskloom.functions.hashing import fast_uniform_sql

Uniform = Callable[[str, str], str]


def number(value: float) -> str:
    return f"{float(value)!r}D"


def round_half_up_sql(value: str, digits: int) -> str:
    """Round by scaling and flooring: several times cheaper per value than the decimal `round`."""
    unit = number(10**digits)
    return f"floor({value} * {unit} + 0.5D) / {unit}"


@dataclass(frozen=True)
class Draw:
    """How one column is drawn.

    kind     integer   floor of U(low, high)
             real      U(low, high) rounded to `digits`, not above `cap`
             product_integer / product_real   the same for U(0,1) * U(low, high)
             choice    one of `options`, evenly, or by `weights`
    """

    kind: str
    low: float = 0.0
    high: float = 1.0
    digits: int = 0
    cap: float | None = None
    options: tuple = ()
    weights: tuple = ()

    def sql(self, key: str, name: str, uniform: Uniform = fast_uniform_sql) -> str:
        """SQL text of the column `name` for the row key column `key`."""
        u = uniform(key, name)
        if self.kind == "choice":
            return f"{self._choice(u)} AS {name}"
        value = f"({number(self.low)} + {u} * {number(self.high - self.low)})"
        if self.kind.startswith("product"):
            value = f"({uniform(key, name + '/2')} * {value})"
        if self.kind.endswith("integer"):
            return f"cast(floor({value}) AS int) AS {name}"
        if self.cap is not None:
            value = f"least({number(self.cap)}, {value})"
        return f"{round_half_up_sql(value, self.digits)} AS {name}"

    def _choice(self, u: str) -> str:
        options = [f"'{o}'" if isinstance(o, str) else str(o) for o in self.options]
        if not self.weights:
            index = f"cast(floor({u} * {len(options)}) AS int) + 1"
            return f"element_at(array({', '.join(options)}), {index})"
        branches, reached = [], 0
        for option, weight in zip(options[:-1], self.weights):
            reached += weight
            branches.append(f"WHEN {u} < {number(reached / sum(self.weights))} THEN {option}")
        return f"CASE {' '.join(branches)} ELSE {options[-1]} END"
