"""Table contracts: which columns a transform needs, in which types, and which names it takes for itself."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.functions.normalize import header_key


@dataclass(frozen=True)
class Contract:
    """required and optional map names to types; aliases lists other names of a column, of which exactly one may be there."""

    required: Mapping[str, str]
    optional: Mapping[str, str] = field(default_factory=dict)
    aliases: Mapping[str, Sequence[str]] = field(default_factory=dict)
    reserved: Sequence[str] = ()
    exact_order: bool = False

    def _source(self, df: DataFrame, name: str) -> str | None:
        keys = {header_key(x) for x in (name, *self.aliases.get(name, ()))}
        found = [c for c in df.columns if header_key(c) in keys]
        if name in df.columns:
            return name
        if len(found) > 1:
            raise ValueError(f"{name}: several columns fit: {found}")
        return found[0] if found else None

    def apply(self, df: DataFrame) -> DataFrame:
        """The contract's columns alone, in its order and types; optional ones that are missing are null."""
        clash = sorted(set(df.columns) & set(self.reserved))
        if clash:
            raise ValueError(f"reserved names are taken: {clash}")
        if self.exact_order and df.columns[: len(self.required)] != list(self.required):
            raise ValueError(f"header differs: {df.columns}")
        out, missing = [], []
        for name, kind in {**self.required, **self.optional}.items():
            source = self._source(df, name)
            if source is not None:
                out.append(F.col(f"`{source}`").try_cast(kind).alias(name))
            elif name in self.required:
                missing.append(name)
            else:
                out.append(F.lit(None).cast(kind).alias(name))
        if missing:
            raise ValueError(f"columns are missing: {missing}")
        return df.select(*out)


def columns_with_prefix(df: DataFrame, *prefixes: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes)]


def check_rows(df: DataFrame, expected: int) -> DataFrame:
    """df, or an error if it hasn't the number of rows that its contract states."""
    if (have := df.count()) != expected:
        raise ValueError(f"{have} rows instead of {expected}")
    return df
