"""Declarative cleaning rules, applied as one projection."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

import yaml
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfwise import constants as K


@dataclass(frozen=True)
class CleaningRules:
    """Rules of one table. All but the renames use the new column names."""

    rename_columns: Mapping[str, str] = field(default_factory=dict)
    type_conversions: Mapping[str, str] = field(default_factory=dict)
    null_replacements: Mapping[str, object] = field(default_factory=dict)
    case_formatting: Mapping[str, str] = field(default_factory=dict)
    standardize_units: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, rules: Mapping | None) -> "CleaningRules":
        rules = rules or {}
        return cls(**{name: rules.get(name) or {} for name in cls.__dataclass_fields__})


def spark_type(name: str) -> str | None:
    """The Spark type of a rule's type name, under its old or its plain spelling."""
    name = name.removesuffix("()")
    if name in K.TYPE_NAMES:
        return K.TYPE_NAMES[name]
    plain = {"integer": "int", "long": "bigint"}.get(name.lower(), name.lower())
    return plain if plain in set(K.TYPE_NAMES.values()) | {"timestamp_ntz"} else None


def repair_type_names(rules: Mapping) -> dict:
    """Give boolean conversions their plain type name."""
    tables = {}
    for table, entry in rules.get("tables", {}).items():
        conversions = (entry or {}).get("type_conversions") or {}
        tables[table] = {**(entry or {}), "type_conversions": {
            c: "boolean" if t == "BooleanType" else t for c, t in conversions.items()}}
    return {**rules, "tables": tables}


def rules_for(table: str, path: str) -> CleaningRules:
    """Rules of one table from a YAML file with a top-level ``tables`` entry."""
    with open(path, encoding="utf-8") as source:
        return CleaningRules.from_dict((yaml.safe_load(source).get("tables") or {}).get(table))


def load_rules(spark: SparkSession, path: str, table: str) -> CleaningRules:
    """Rules of one table from a YAML file of any file system, with boolean type names repaired."""
    text = spark.read.text(path, wholetext=True).first()[0]  # one small file
    return CleaningRules.from_dict(repair_type_names(yaml.safe_load(text) or {})["tables"].get(table))


def rename_existing(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def rename_for_table(df: DataFrame, table: str,
                     renames: Mapping[str, Mapping[str, str]] = K.KEY_RENAMES) -> DataFrame:
    """Rename by a per-table map; a table without an entry stays unchanged."""
    return rename_existing(df, renames.get(table, {}))


def load_renames(spark: SparkSession, path: str) -> dict:
    """The rename maps of a YAML file, in any store that Spark reads; an empty file has none."""
    return yaml.safe_load("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())) or {}


def cased(value: Column, style: str) -> Column:
    styles = {"lower": F.lower, "upper": F.upper, "capitalize": F.initcap}
    return styles[style](value) if style in styles else value


def unit_text(value: Column, old: str, new: str) -> Column:
    """Drop all white space, then replace ``old`` (a pattern) by ``new``."""
    return F.regexp_replace(F.regexp_replace(value.cast("string"), r"\s+", ""), old, new)


def linear_unit(value: Column, factor: float = 1.0, offset: float = 0.0) -> Column:
    return value * F.lit(factor) + F.lit(offset)


def apply_rules(df: DataFrame, rules: CleaningRules) -> DataFrame:
    """Rename, convert, replace nulls, set case and standardise units: one projection."""
    renamed = rename_existing(df, rules.rename_columns)
    out = []
    for fieldinfo in renamed.schema.fields:
        name, dtype, value = fieldinfo.name, fieldinfo.dataType, F.col(f"`{fieldinfo.name}`")
        target = spark_type(rules.type_conversions.get(name, ""))
        if target:
            value = value.try_cast(target)
        if name in rules.null_replacements:
            filler = F.lit(rules.null_replacements[name])
            kind = target or dtype.simpleString()
            value = F.coalesce(value, filler.try_cast(kind))
        if name in rules.case_formatting:
            value = cased(value, rules.case_formatting[name])
        if name in rules.standardize_units:
            change = rules.standardize_units[name]
            value = unit_text(value, change["from"], change["to"])
        out.append(value.alias(name))
    return renamed.select(*out)

