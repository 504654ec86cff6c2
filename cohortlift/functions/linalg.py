"""Small symmetric linear systems solved with column expressions, one system per row.

Every function returns ``(name, sql)`` pairs in evaluation order; a later pair may use the names
of earlier ones, which Spark resolves inside one select (lateral column aliases).
"""

from __future__ import annotations

from collections.abc import Callable

Steps = list[tuple[str, str]]


def factor(size: int, entry: Callable[[int, int], str], pivot_floor: float = 0.0) -> Steps:
    """LDL' factors of the matrix ``entry(i, j)`` (i >= j) as ``_d{j}`` and ``_l{i}_{j}``.

    A pivot not above ``pivot_floor`` times its diagonal entry becomes null, and with it
    everything solved from the factors.
    """
    steps: Steps = []
    for j in range(size):
        pivot = " - ".join([entry(j, j), *(f"_l{j}_{m} * _l{j}_{m} * _d{m}" for m in range(j))])
        steps.append((f"_p{j}", pivot))
        steps.append((f"_d{j}", f"if(_p{j} > {pivot_floor!r}D * abs({entry(j, j)}), _p{j}, null)"))
        for i in range(j + 1, size):
            rest = " - ".join([entry(i, j), *(f"_l{i}_{m} * _l{j}_{m} * _d{m}" for m in range(j))])
            steps.append((f"_l{i}_{j}", f"try_divide({rest}, _d{j})"))
    return steps


def forward(rhs: list[str], prefix: str) -> Steps:
    """Solve L u = rhs into ``{prefix}{i}``."""
    return [
        (f"{prefix}{i}", " - ".join([value, *(f"_l{i}_{m} * {prefix}{m}" for m in range(i))]))
        for i, value in enumerate(rhs)
    ]


def solve(rhs: list[str], out: str) -> Steps:
    """Solve the factored system into ``{out}{i}``."""
    steps = forward(rhs, "_u")
    for i in reversed(range(len(rhs))):
        above = (f"_l{m}_{i} * {out}{m}" for m in range(i + 1, len(rhs)))
        steps.append((f"{out}{i}", " - ".join([f"try_divide(_u{i}, _d{i})", *above])))
    return steps


def select_list(steps: Steps) -> list[str]:
    return [f"{sql} as {name}" for name, sql in steps]
