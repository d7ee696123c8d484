"""Scalar expressions on features, text and attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap_bp(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Shared bases of two inclusive intervals, 0 if none."""
    return F.greatest(F.least(e1, e2) - F.greatest(s1, s2) + 1, F.lit(0).cast("long"))


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Touching intervals overlap, adjacent ones don't."""
    return (s1 <= e2) & (s2 <= e1)


def reverse_complement(seq: Column) -> Column:
    """Case is kept; ambiguity codes are complemented, other letters stay."""
    return F.reverse(F.translate(seq, "ACGTUNRYKMSWBDHVacgtunrykmswbdhv", "TGCAANYRMKSWVHDBtgcaanyrmkswvhdb"))


def swap_kind(identifier: Column, old: str, new: str) -> Column:
    """Every occurrence of `old` (a pattern) becomes `new`; an id without one gets ':new' appended."""
    out = F.regexp_replace(identifier, old, new)
    return F.when(out == identifier, F.concat(identifier, F.lit(":" + new))).otherwise(out)


def first_word(text: Column) -> Column:
    """Up to the first space."""
    return F.substring_index(text, " ", 1)


def pfam_accession(accession: Column, name: Column) -> Column:
    """Without its version; where there is none, the hit's name."""
    return F.coalesce(F.nullif(F.regexp_replace(F.coalesce(accession, F.lit("")), r"\.\d+$", ""), F.lit("")), name)


# How definitions write EC numbers.
EC_TAG = r"\s*\[EC:([0-9.\-,nN\s]+)\]"
EC_NUMBER = r"^[1-7](\.(\d+|-|n\d+)){3}$"


def ec_numbers(definition: Column) -> Column:
    """The valid EC numbers of all tags, each once, in order."""
    tokens = F.flatten(F.transform(F.regexp_extract_all(definition, F.lit(EC_TAG), F.lit(1)), lambda t: F.split(F.trim(t), r"[\s,]+")))
    return F.array_distinct(F.filter(tokens, lambda t: t.rlike(EC_NUMBER)))


def without_ec(definition: Column) -> Column:
    """The definition without its tags, valid or not."""
    return F.trim(F.regexp_replace(definition, EC_TAG, ""))


def clean_product(text: Column) -> Column:
    """struct(text, organism, fragment): a product name without its ' OS=' tail and '(Fragment)', and whether it had them."""
    cut = F.when(F.locate(" OS=", text) > 0, F.substring(text, F.lit(1), F.locate(" OS=", text) - 1)).otherwise(text)
    bare = F.trim(F.replace(F.replace(cut, F.lit(" (Fragment)"), F.lit("")), F.lit("(Fragment)"), F.lit("")))
    return F.struct(F.when(bare == "", F.lit("hypothetical protein")).otherwise(bare).alias("text"), (F.locate(" OS=", text) > 0).alias("organism"), F.contains(cut, F.lit("(Fragment)")).alias("fragment"))


def splice_code(kind: Column) -> Column:
    """'GT-AG' -> 'gtag'; null for anything not of that shape."""
    return F.when(kind.rlike("^..-..$"), F.lower(F.replace(kind, F.lit("-"), F.lit(""))))


def fixed(value: Column, places: int = 6) -> Column:
    """A fraction with so many places, rounded by its exact binary value, ties to even; format_string rounds the shortest decimal half up.

    The value is split in two halves of 26 bits, so that their products with 2 * 10 ** places (six places at most) are
    exact. Values of a billion or more, infinite ones and NaN are left to format_string; null stays null.
    """
    if places > 6:
        raise ValueError("six places at most")
    x, scale = F.abs(value), 10.0**places
    high = x * 134217729.0 - (x * 134217729.0 - x)
    below = F.floor(x * scale)
    rest = (high * (2 * scale) - (below * 2 + 1).cast("double")) + (x - high) * (2 * scale)
    rounded = below + F.when((rest > 0) | ((rest == 0) & (below % 2 == 1)), 1).otherwise(0)
    exact = F.format_string(f"%.{places}f", F.when(value < 0, -rounded).otherwise(rounded) / scale)
    return F.when(x < 1e9, exact).when(value.isNotNull(), F.format_string(f"%.{places}f", value))


def percent(value: Column) -> Column:
    return F.concat(fixed(value.cast("double") * 100, 1), F.lit("%"))


def bar(value: Column, width: int = 20) -> Column:
    """A bar of `width` cells in brackets, filled by truncation."""
    full = (value * width).cast("int")
    return F.concat(F.lit("["), F.repeat(F.lit("#"), full), F.repeat(F.lit("."), F.lit(width) - full), F.lit("]"))


def raw_attribute(text: Column, key: str) -> Column:
    """The text after the last 'key=' of a GFF3 attribute column, up to ';' as it stands; null where there is none."""
    parts = F.filter(F.split(text, ";"), lambda p: F.startswith(p, F.lit(f"{key}=")))
    return F.when(F.size(parts) > 0, F.substring(F.element_at(parts, -1), F.lit(len(key) + 2), F.length(text)))


def attribute_map(text: Column) -> Column:
    """map<string, array<string>> from 'k=v1,v2;k2=v' (GFF3). Later keys win; values are URL-decoded after splitting."""
    # a stray '%' is kept as it is
    decode = lambda v: F.coalesce(F.try_url_decode(F.replace(v, F.lit("+"), F.lit("%2B"))), v)
    parts = F.filter(F.transform(F.split(text, ";"), lambda p: F.trim(p)), lambda p: (p != "") & F.contains(p, F.lit("=")))
    pairs = F.transform(parts, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.transform(F.split(F.substring(p, F.locate("=", p) + 1, F.length(p)), ","), decode).alias("v")))
    last = F.reduce(pairs, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>")), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.map_from_arrays(F.array(p["k"]), F.array(p["v"]))))
    return last


def gtf_map(text: Column) -> Column:
    """The same from 'k "v"; k2 "v2";' (GTF)."""
    keys, values = F.regexp_extract_all(text, F.lit(r'(\w+)\s+"([^"]*)"'), F.lit(1)), F.regexp_extract_all(text, F.lit(r'(\w+)\s+"([^"]*)"'), F.lit(2))
    pairs = F.arrays_zip(keys.alias("k"), F.transform(values, lambda v: F.array(v)).alias("v"))
    return F.reduce(pairs, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>")), lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["k"]), F.map_from_arrays(F.array(p["k"]), F.array(p["v"]))))


def attribute_text(attributes: Column) -> Column:
    """'k=v1,v2;k2=v': the inverse of attribute_map; reserved characters are percent-encoded."""
    encode = lambda v: F.reduce(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in (("%", "%25"), (";", "%3B"), ("=", "%3D"), ("&", "%26"), (",", "%2C")))), v, lambda acc, x: F.replace(acc, x["a"], x["b"]))
    return F.array_join(F.transform(F.map_entries(attributes), lambda e: F.concat(e["key"], F.lit("="), F.array_join(F.transform(e["value"], encode), ","))), ";")


def first_value(attributes: Column, key: str) -> Column:
    return F.get(F.try_element_at(attributes, F.lit(key)), 0)
