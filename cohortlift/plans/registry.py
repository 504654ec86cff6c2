"""Named methods and the plug-in surface for new ones."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from cohortlift.operators import estimators, matching

Leaf = Callable[[DataFrame], DataFrame]

#: Imputation methods applied together in one pass.
IMPUTATIONS = ("standard", "aggressive_impute")

_MATCHING_OUTPUT = {"weight": "double", "unit_id": "string"}
_MODEL_OUTPUT = {
    "study_id": "string", "estimate": "double", "std_error": "double", "ci_low": "double",
    "ci_high": "double",
}
_KEYS = {"study_id": "string", "patient_id": "bigint", "treatment": "int"}


class ContractError(ValueError):
    """A plug-in returned a table that the next stage cannot use."""


@dataclass
class Registry:
    """Method name -> function of a DataFrame holding all studies that use the method.

    A feature leaf maps cohort rows to feature rows, a matching leaf adds ``weight`` and
    ``unit_id`` (unique within a study) to feature rows, a model leaf maps matched rows to one
    result row per study.
    """

    feature: dict[str, Leaf] = field(default_factory=dict)
    matching: dict[str, Leaf] = field(
        default_factory=lambda: {
            "exact": matching.match_exact,
            "knn": matching.match_knn,
            "ipw": matching.match_ipw,
            "stratified": matching.match_stratified,
            "none": matching.match_none,
        }
    )
    model: dict[str, Leaf] = field(default_factory=dict)

    def register(self, kind: str, name: str, leaf: Leaf) -> None:
        getattr(self, kind)[name] = leaf

    def known(self, kind: str) -> set[str]:
        builtin = {"feature": {*IMPUTATIONS, "panel"}, "model": set(estimators.MODELS)}
        return set(getattr(self, kind)) | builtin.get(kind, set())

    def reject_unknown(self, kind: str, names: Iterable[str | None]) -> None:
        unknown = sorted(str(name) for name in set(names) - self.known(kind))
        if unknown:
            raise ValueError(f"Unknown {kind}_method: {', '.join(unknown)}")

    def run(self, kind: str, name: str, df: DataFrame) -> DataFrame:
        """Apply a leaf and check the schema of what it returns."""
        out = getattr(self, kind)[name](df)
        wanted = {
            "feature": _KEYS,
            "matching": {**{f.name: f.dataType.simpleString() for f in df.schema if f.name != "ps"},
                         **_MATCHING_OUTPUT},
            "model": _MODEL_OUTPUT,
        }[kind]
        actual = {f.name: f.dataType.simpleString() for f in out.schema}
        wrong = [f"{n} {t}" for n, t in wanted.items() if actual.get(n) != t]
        if wrong:
            raise ContractError(f"{kind} method {name} must return {', '.join(wrong)}")
        return out
