"""Keyword, priority and text flags.

The flag tables are long, so their columns are written as expression text: one
call per column instead of one per operator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid import constants as C


def as_bit(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def _keyword_sql(column: str, any_of: list[str], none_of: list[str], ignore_case: bool) -> str:
    source = f"lower({column})" if ignore_case else column
    found = " OR ".join(f"contains({source}, '{word}')" for word in any_of)
    hidden = "".join(f" AND NOT contains({source}, '{word}')" for word in none_of)
    return f"({found}){hidden}"


def keyword_conditions(column: str, table: dict) -> dict[str, str]:
    """One condition per row of a keyword table, over a description column."""
    return {name: _keyword_sql(column, *rule) for name, rule in table.items()}


def priority_conditions(column: str) -> dict[str, str]:
    return {name: f"{column} = {value}" for name, value in zip(C.PRIORITY_FLAGS, C.PRIORITY_VALUES)}


def flag_columns(conditions: dict[str, str]) -> dict[str, Column]:
    """One 0/1 column per condition; an unknown one gives 0."""
    return {name: F.expr(f"CAST(coalesce({text}, false) AS INT)") for name, text in conditions.items()}


def keyword_flags(column: str, table: dict) -> dict[str, Column]:
    return flag_columns(keyword_conditions(column, table))


def all_keyword_flags(clue: str = "CLUE_DESC", cause: str = "CAUSE_DESC", occurrence: str = "OCCURN_DESC") -> dict[str, Column]:
    return {
        **keyword_flags(clue, C.CLUE_KEYWORDS),
        **keyword_flags(cause, C.CAUSE_KEYWORDS),
        **keyword_flags(occurrence, C.OCCURRENCE_KEYWORDS),
    }


def priority_flags(column: str = "PRIORITY_VAL") -> dict[str, Column]:
    return flag_columns(priority_conditions(column))


def pack(conditions: dict[str, str]) -> Column:
    """Conditions as the bits of one number, the first in the lowest bit."""
    return F.expr(" | ".join(f"IF(coalesce({text}, false), {1 << i}L, 0L)" for i, text in enumerate(conditions.values())))


def unpack(df: DataFrame, masks: dict[str, list[str]]) -> DataFrame:
    """0/1 columns in place of packed numbers; a missing number has no bit set.

    The default is filled in once per number: the generated code of fifty columns has
    to stay short enough for the JVM to compile it.
    """
    known = df.withColumns({mask: F.coalesce(mask, F.lit(0).cast("bigint")) for mask in masks})
    bits = {name: F.expr(f"CAST(getbit({mask}, {i}) AS INT)") for mask, names in masks.items() for i, name in enumerate(names)}
    return known.withColumns(bits).drop(*masks)


def flags_to_text(df: DataFrame, names: list[str] = C.TEXT_FLAGS) -> DataFrame:
    """1 -> 'True', 0 -> 'False', anything else -> null."""
    return df.withColumns({name: F.expr(f"CASE {name} WHEN 1 THEN 'True' WHEN 0 THEN 'False' END") for name in names})


def model_indicators(df: DataFrame) -> DataFrame:
    """0/1 inputs of the restoration model taken from the text flags and the city."""
    conditions = {f"{name}_False": f"{name} = 'False'" for name in C.INDICATORS_FALSE}
    conditions |= {f"{name}_True": f"{name} = 'True'" for name in C.INDICATORS_TRUE}
    conditions["CITY_NAM_NO_CITY"] = f"CITY_NAM = '{C.NO_CITY}'"
    return df.withColumns(flag_columns(conditions))


def outage_label(*keys: str) -> Column:
    """Identifier text: the grain keys side by side, without a separator."""
    return F.concat(*[F.col(key).cast("string") for key in (keys or C.GRAIN)])


def strip_spaces(text: Column) -> Column:
    return F.translate(text, " ", "")


def normal_city(city: Column) -> Column:
    return F.when(city.contains("INDIAN"), "INDIANAPOLIS").otherwise(F.coalesce(city, F.lit(C.NO_CITY)))
