"""Quantities recorded in different units: one value per row in the default unit of its analyte.

Semantics of :func:`normalize_quantities`
-----------------------------------------
* A row takes part if its ``standard_name`` is one of the terms; all others are left out. Repeated deliveries with the
  same content give one row.
* ``value_num``: the number that the value holds (full-width digits, decimal comma, exponents, signs and marks are
  read); null where the value is null, empty or holds none - such rows stay, with null results.
* The unit is looked for in ``unit`` (unless ``unit_source`` is ``controlled_default``), then behind the number in
  ``value``, in the brackets or tail of ``raw_name``, and in ``remark`` (not a unit that follows another number there).
  ``unit_origin`` says where it was found: ``unit``, ``value``, ``raw_name``, ``remark``; ``interval`` where the printed
  interval decides between the units of the term; ``none`` where nothing does, with a null factor.
* Texts that state no unit of the term's dimensions count as no statement. Null in any column is allowed.
* Empty tables give an empty result. Columns beyond the named ones are ignored.

Scale: one narrow pass over the observations; the only shuffles are the final de-duplication and one partial
aggregation to a row per term. The term list is a dictionary; more than ``MAX_TERMS`` entries are refused.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from quillon.functions.units import plain, resolve
from quillon.operators.joins import lookup_join
from quillon.session import broadcast_if_small, checkpointed

#: Bound on the dictionary of terms that is sent to every task; the most words that one unit is spelled in.
MAX_TERMS, UNIT_WORDS = 20_000, 12
_NUMERIC = re.compile(r"[<>≤≥~]?[-+]?\d[\d.,]*(?:[eE][-+]?\d+)?$")
_POWER = re.compile(r"10\s*(?:\^|[eE*])\s*[-+]?\d")
NAME_TAILS = (re.compile(r"[(\[]([^()\[\]]*)[)\]]\s*$"), re.compile(r",\s*([^,]+)$"), re.compile(r"\sin\s+(\S.*)$"))
Field = tuple[tuple[str, float], ...]


def fields_of(terms: DataFrame, conversions: DataFrame) -> dict[str, Field]:
    """``standard_name`` -> its units with their factors, the default unit first."""
    rows = terms.select("term_id", "standard_name", "default_unit").dropna().distinct().limit(MAX_TERMS + 1).collect()
    if len(rows) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} terms: not a dictionary")
    more: dict[str, list] = defaultdict(list)
    factors = conversions.select("term_id", "source_unit", "factor").dropna().distinct().orderBy("source_unit").limit(50 * MAX_TERMS + 1).collect()
    if len(factors) > 50 * MAX_TERMS:
        raise ValueError(f"more than {50 * MAX_TERMS} conversions: not a dictionary")
    for r in factors:
        more[r.term_id].append((r.source_unit, float(r.factor)))
    return {r.standard_name: ((r.default_unit, 1.0), *more[r.term_id]) for r in rows}


def unit_in_words(text: str | None, field: Field) -> tuple[str, float] | None:
    """The longest run of words of ``text`` that is a unit of the field and does not belong to another number."""
    if not text:
        return None
    words = [w for w in (x.strip("()[]{},;:。，；：") for x in plain(text).split(" ")) if w]
    for n in range(min(UNIT_WORDS, len(words)), 0, -1):
        for i in range(len(words) - n + 1):
            run = " ".join(words[i : i + n])
            if i and _NUMERIC.match(words[i - 1]) or run[0].isdigit() and not _POWER.match(run):
                continue
            if found := resolve(run, field):
                return found
    return None


def unit_in_name(name: str | None, field: Field) -> tuple[str, float] | None:
    """A unit in the brackets at the end of a name, behind its last comma or behind the word ``in``."""
    for tail in NAME_TAILS if name else ():
        if (m := tail.search(name)) and (found := resolve(m[1].strip(), field)):
            return found
    return None


def _stated(fields: dict[str, Field]):
    """The pandas UDF of the statement: (name, unit, rest of the value, raw name, remark) -> origin, unit, factor."""

    @F.pandas_udf("origin string, unit string, factor double")
    def stated(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        known: dict = {}
        for columns in parts:
            out = []
            for key in zip(*(c.where(c.notna(), None) for c in columns)):
                if key not in known:
                    name, unit, rest, raw, remark = key
                    field = fields.get(name, ())
                    for origin, found in (
                        ("unit", resolve(unit.strip(), field) if unit else None),
                        ("value", resolve(rest.strip(), field) if rest else None),
                        ("raw_name", unit_in_name(raw, field)),
                        ("remark", unit_in_words(remark, field)),
                    ):
                        if found:
                            break
                    if len(known) > 200_000:
                        known.clear()
                    known[key] = (origin, *found) if found else (None, None, None)
                out.append(known[key])
            yield pd.DataFrame(out, columns=["origin", "unit", "factor"])

    return stated


def number_of(value: Column) -> Column:
    """The first number of a text; full-width digits and a decimal comma are read, null if there is none."""
    ascii_ = F.translate(value, "０１２３４５６７８９．，－＋", "0123456789.,-+")
    found = F.regexp_extract(ascii_, r"([-+]?\d+(?:[.,]\d+)*(?:[eE][-+]?\d+)?)", 1)
    plain_ = F.when(found.contains(".") & found.contains(","), F.regexp_replace(found, ",", "")).otherwise(F.regexp_replace(found, ",", "."))
    return F.when(found != "", plain_.try_cast("double"))


def _rest(value: Column) -> Column:
    """What follows the number of a value, without the marks of a report."""
    ascii_ = F.translate(value, "０１２３４５６７８９．，－＋", "0123456789.,-+")
    rest = F.trim(F.regexp_extract(ascii_, r"^\s*[<>≤≥~]?\s*[-+]?\d+(?:[.,]\d+)*(?:[eE][-+]?\d+(?![\d/]))?(.*)$", 1))
    rest = F.trim(F.regexp_replace(rest, r"[↑↓*!+]+$", ""))
    return F.when(~rest.isin("", "H", "L", "HH", "LL"), rest)


def normalize_quantities(observations: DataFrame, terms: DataFrame, conversions: DataFrame, distinct: bool = True) -> DataFrame:
    """Every observation of a known term in the term's default unit; see the module text for the semantics.

    ``distinct=False`` leaves repeated deliveries to a later step that removes them with less to shuffle.
    """
    fields = fields_of(terms, conversions)
    spark = observations.sparkSession
    names = spark.createDataFrame(
        [(n, f[0][0], [{"unit": u, "factor": x} for u, x in f]) for n, f in fields.items()],
        "standard_name string, default_unit string, units array<struct<unit:string,factor:double>>",
    )
    ids = terms.select("standard_name", "term_id").dropna().distinct()
    names = broadcast_if_small(names.join(ids, "standard_name"), MAX_TERMS)
    used = observations.select("obs_id", "raw_name", "standard_name", "value", "unit", "unit_source", "ref_lower", "ref_upper", "remark")
    rows = used.filter(F.col("standard_name").isNotNull()).join(names, "standard_name")
    given = F.when(~F.col("unit_source").eqNullSafe("controlled_default"), F.col("unit"))
    # texts of the unit column that are no unit of their term: found once over the distinct ones, so that these rows are
    # read further like rows without a unit
    none = F.lit(None).cast("string")
    texts = rows.select(F.col("standard_name").alias("_on"), F.trim(given).alias("_og")).filter("_og <> ''").distinct()
    odd = checkpointed(texts.withColumn("_r", _stated(fields)("_on", "_og", none, none, none)).filter("_r.factor is null").select("_on", "_og"))
    rows = rows.withColumn("_g", F.trim(given))
    small = broadcast_if_small(odd, MAX_TERMS)
    on = (F.col("standard_name") == F.col("_on")) & (F.col("_g") == F.col("_og"))
    rows = lookup_join(rows, odd, ["standard_name", "_g"], ["_on", "_og"]) if small is odd else rows.join(small, on, "left")
    # a row states its unit in the unit column nine times in ten; the longer texts are only sent to Python where it does not
    bare = given.isNull() | (F.trim(given) == "") | F.col("_og").isNotNull()
    stated = _stated(fields)("standard_name", given, F.when(bare, _rest(F.col("value"))), F.when(bare, F.col("raw_name")), F.when(bare, F.col("remark")))
    rows = rows.withColumn("_s", stated).withColumn("value_num", number_of(F.col("value")))
    # typical interval of each term in its default unit, from the rows that state their unit
    scaled = rows.filter("_s.factor is not null").select("term_id", (F.col("ref_lower") * F.col("_s.factor")).alias("lo"), (F.col("ref_upper") * F.col("_s.factor")).alias("hi"))
    typical = scaled.groupBy("term_id").agg(
        F.percentile_approx(F.when(F.col("lo") > 0, F.col("lo")), 0.5, 1000).alias("_lo"),
        F.percentile_approx(F.when(F.col("hi") > 0, F.col("hi")), 0.5, 1000).alias("_hi"),
    )
    rows = rows.join(F.broadcast(typical), "term_id", "left")  # a row per term: at most MAX_TERMS

    def off(bound: str, usual: str, u: Column) -> Column:
        b, t = F.col(bound), F.col(usual)
        return F.when((b > 0) & (t > 0), F.abs(F.log(b * u["factor"] / t))).otherwise(F.lit(0.0))

    fits = F.transform("units", lambda u: F.struct((off("ref_lower", "_lo", u) + off("ref_upper", "_hi", u)).alias("off"), u["unit"].alias("unit"), u["factor"].alias("factor")))
    has_interval = ((F.col("ref_lower") > 0) & F.col("_lo").isNotNull()) | ((F.col("ref_upper") > 0) & F.col("_hi").isNotNull())
    shown = F.when(F.col("_s.factor").isNull() & has_interval, F.array_min(fits))
    rows = rows.withColumn("_i", shown)
    factor = F.coalesce("_s.factor", "_i.factor")
    out = rows.select(
        "obs_id", "term_id", "standard_name", "value", "value_num",
        F.coalesce("_s.unit", "_i.unit").alias("unit"),
        F.when(F.col("_s.factor").isNotNull(), F.col("_s.origin")).when(F.col("_i").isNotNull(), "interval").otherwise("none").alias("unit_origin"),
        "unit_source", "default_unit", factor.alias("factor"),
        (F.col("value_num") * factor).alias("value_normalized"),
        (F.col("ref_lower") * factor).alias("ref_lower_normalized"),
        (F.col("ref_upper") * factor).alias("ref_upper_normalized"),
    )
    return out.distinct() if distinct else out


def converted(normalized: DataFrame) -> DataFrame:
    """``obs_id`` of the rows that hold a number and whose unit differs from the default unit in scale."""
    return normalized.filter(F.col("value_num").isNotNull() & (F.abs(F.col("factor") - 1) > 1e-9)).select("obs_id").distinct()
