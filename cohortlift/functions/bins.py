"""Right-closed numeric bins."""

# Bin edges of the coarsened covariates.
AGE_EDGES = (0, 50, 60, 70, 200)
RISK_EDGES = (0, 1, 1.5, 2, 100)


def right_closed_bin(column: str, edges: tuple[float, ...]) -> str:
    """SQL for the index of the bin (edge, next edge] holding ``column``, null outside."""
    cases = " ".join(
        f"when {column} > {float(low)!r}D and {column} <= {float(high)!r}D then {index}"
        for index, (low, high) in enumerate(zip(edges, edges[1:]))
    )
    return f"case {cases} end"
