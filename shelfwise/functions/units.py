"""Unit texts such as ``128 MB`` as expressions over specification maps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfwise import constants as K

_QUANTITY = r"^\s*([0-9.]+)\s*([a-zA-Z]+)\s*$"


def key_family(key: Column) -> Column:
    """The unit family a specification key names, or NULL."""
    lowered, family = F.lower(key), F.lit(None).cast("string")
    for name, words in reversed(K.FAMILY_KEY_WORDS):
        hit = lowered.contains(words[0])
        for word in words[1:]:
            hit = hit | lowered.contains(word)
        family = F.when(hit, F.lit(name)).otherwise(family)
    return family


def _lookup(table: dict, key: Column) -> Column:
    """The value of a small fixed table, or NULL."""
    entries = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*entries), key)


FACTOR = {unit: f for units in K.UNIT_FACTORS.values() for unit, f in units.items()}
FAMILY = {unit: family for family, units in K.UNIT_FACTORS.items() for unit in units}


def standard_quantity(key: Column, value: Column, strict: bool = False) -> Column:
    """``value`` in the standard unit of the key's family, or ``value`` unchanged.

    The factor is that of the written unit and the label that of the key. With ``strict`` both
    must be of one family; otherwise the value stays as it is.
    """
    number = F.regexp_extract(value, _QUANTITY, 1).try_cast("double")
    unit = F.regexp_extract(value, _QUANTITY, 2)
    family = key_family(key)
    if strict:
        family = F.when(_lookup(FAMILY, unit) == family, family)
    # bround: ties go to the even digit, as in 0.125 -> 0.12. NULL anywhere leaves the value.
    amount = F.bround(number * _lookup(FACTOR, unit), 2).try_cast("decimal(38,2)")
    converted = F.concat(amount.cast("string"), F.lit(" "), _lookup(K.UNIT_LABELS, family))
    return F.coalesce(converted, value)


def standard_specifications(specs: Column, strict: bool = False) -> Column:
    return F.transform_values(specs, lambda k, v: standard_quantity(k, v, strict))
