"""Tail of the standard normal distribution as a SQL expression (Spark has no ``erf``)."""

# Rational approximation of the upper tail published by Hart and by West.
_NUMERATOR = (
    "3.52624965998911e-2", "0.700383064443688e0", "6.37396220353165e0", "33.912866078383e0",
    "112.079291497871e0", "221.213596169931e0", "220.206867912376e0",
)
_DENOMINATOR = (
    "8.83883476483184e-2", "1.75566716318264e0", "16.064177579207e0", "86.7807322029461e0",
    "296.564248779674e0", "637.333633378831e0", "793.826512519948e0", "440.413735824752e0",
)
_SWITCH = "7.07106781186547e0"
_ROOT_TWO_PI = "2.506628274631e0"


def _horner(coefficients: tuple[str, ...], a: str) -> str:
    text = coefficients[0]
    for coefficient in coefficients[1:]:
        text = f"({text} * {a} + {coefficient})"
    return text


def two_sided_p(z: str) -> str:
    """SQL for the probability that a standard normal is at least as far from 0 as ``z``.

    Plain arithmetic, valid in any ANSI dialect.
    """
    a = f"abs({z})"
    near = f"{_horner(_NUMERATOR, a)} / {_horner(_DENOMINATOR, a)}"
    far = f"1.0e0 / ({a} + 1.0e0 / ({a} + 2.0e0 / ({a} + 3.0e0 / ({a} + 4.0e0 / ({a} + 0.65e0)))))"
    tail = f"case when {a} < {_SWITCH} then {near} else {far} / {_ROOT_TWO_PI} end"
    return f"(2.0e0 * exp(-0.5e0 * {a} * {a}) * ({tail}))"
