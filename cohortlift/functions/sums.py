"""Sums of doubles that do not depend on the order of their terms.

Each term is split into a multiple of a coarse unit and a multiple of a fine one.  The units are powers of two,
so large that all sums of a group are whole multiples of them within 53 bits: adding such numbers rounds
nothing, whatever the order.  The two units together keep about 75 bits below the largest term for a
million terms.
"""

from __future__ import annotations


def largest(x: str) -> str:
    """SQL aggregate for the largest finite size of ``x``; 1 where there is none but zero."""
    return f"coalesce(nullif(max(if(abs({x}) < 1.7976931348623157e308, abs({x}), null)), 0e0), 1e0)"


def grids(name: str, most: str, n: str) -> dict[str, str]:
    """SQL of two numbers per group; adding one of them and taking it off again rounds to its unit.

    ``most`` is the largest size of a term and ``n`` the number of terms; counts may draw a group's terms up
    to four times over in all.  Powers come from logarithms a little above the true ones, so that an exact
    power of two cannot fall on either side.
    """
    room = f"ceil(log2(4e0 * {n} * 1.0000001e0))"
    top = f"ceil(log2({most} * 1.0000001e0)) + {room} + 1e0"
    return {
        f"{name}_coarse": f"1.5e0 * power(2e0, {top})",
        f"{name}_fine": f"1.5e0 * power(2e0, {top} - 52e0 + {room})",
    }


def bins(name: str) -> dict[str, str]:
    """SQL of the two parts of a term."""
    high = f"(({name} + {name}_coarse) - {name}_coarse)"
    return {f"{name}_high": high, f"{name}_low": f"((({name} - {high}) + {name}_fine) - {name}_fine)"}
