"""Column masking with built-in functions: upper case to X, lower case to x, digits to n."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mask(value: Column) -> Column:
    return F.mask(value)


def mask_first_n(value: Column, n: int = 4) -> Column:
    return F.concat(F.mask(F.substring(value, 1, n)), F.substr(value, F.lit(n + 1)))


def mask_last_n(value: Column, n: int = 4) -> Column:
    kept = F.greatest(F.length(value) - n, F.lit(0))
    return F.concat(F.left(value, kept), F.mask(F.substr(value, kept + 1)))


def mask_show_first_n(value: Column, n: int = 4) -> Column:
    return F.concat(F.substring(value, 1, n), F.mask(F.substr(value, F.lit(n + 1))))


def mask_show_last_n(value: Column, n: int = 4) -> Column:
    hidden = F.greatest(F.length(value) - n, F.lit(0))
    return F.concat(F.mask(F.left(value, hidden)), F.substr(value, hidden + 1))


def mask_hash(value: Column) -> Column:
    return F.sha2(value, 256)


KINDS = {
    "mask": mask,
    "mask_first_n": mask_first_n,
    "mask_last_n": mask_last_n,
    "mask_show_first_n": mask_show_first_n,
    "mask_show_last_n": mask_show_last_n,
    "mask_hash": mask_hash,
}


def mask_columns(df: DataFrame, columns: list[str] | dict[str, str]) -> DataFrame:
    """`df` with the named string columns masked, all in one way or each by the kind given for it."""
    kinds = columns if isinstance(columns, dict) else dict.fromkeys(columns, "mask")
    unknown = set(kinds.values()) - set(KINDS)
    if unknown:
        raise ValueError(f"unknown masks: {sorted(unknown)}")
    return df.withColumns({name: KINDS[kind](F.col(name)) for name, kind in kinds.items()})
