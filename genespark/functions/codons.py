"""Genetic codes: amino acids, start and stop codons of the NCBI translation tables."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

BASES = "TCAG"
STANDARD = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = ["".join(c) for c in product(BASES, repeat=3)]
# What differs from the standard code, and the start codons.
CHANGES = {
    1: {},
    2: {"AGA": "*", "AGG": "*", "ATA": "M", "TGA": "W"},
    3: {"ATA": "M", "CTT": "T", "CTC": "T", "CTA": "T", "CTG": "T", "TGA": "W"},
    4: {"TGA": "W"},
    5: {"AGA": "S", "AGG": "S", "ATA": "M", "TGA": "W"},
    6: {"TAA": "Q", "TAG": "Q"},
    9: {"AAA": "N", "AGA": "S", "AGG": "S", "TGA": "W"},
    10: {"TGA": "C"},
    11: {},
    12: {"CTG": "S"},
    13: {"AGA": "G", "AGG": "G", "ATA": "M", "TGA": "W"},
    14: {"AAA": "N", "AGA": "S", "AGG": "S", "TAA": "Y", "TGA": "W"},
    15: {"TAG": "Q"},
    16: {"TAG": "L"},
    21: {"TGA": "W", "ATA": "M", "AGA": "S", "AGG": "S", "AAA": "N"},
    22: {"TCA": "*", "TAG": "L"},
    23: {"TTA": "*"},
    24: {"AGA": "S", "AGG": "K", "TGA": "W"},
    25: {"TGA": "G"},
    26: {"CTG": "A"},
    27: {"TAA": "Q", "TAG": "Q", "TGA": "W"},
    28: {"TAA": "Q", "TAG": "Q", "TGA": "W"},
    29: {"TAA": "Y", "TAG": "Y"},
    30: {"TAA": "E", "TAG": "E"},
    31: {"TAA": "E", "TAG": "E", "TGA": "W"},
    32: {"TAG": "W"},
    33: {"TAA": "Y", "AGA": "S", "AGG": "K", "TGA": "W"},
}
STARTS = {
    1: ("TTG", "CTG", "ATG"),
    2: ("ATT", "ATC", "ATA", "ATG", "GTG"),
    3: ("ATA", "ATG", "GTG"),
    4: ("TTA", "TTG", "CTG", "ATT", "ATC", "ATA", "ATG", "GTG"),
    5: ("TTG", "ATT", "ATC", "ATA", "ATG", "GTG"),
    6: ("ATG",),
    9: ("ATG", "GTG"),
    10: ("ATG",),
    11: ("TTG", "CTG", "ATT", "ATC", "ATA", "ATG", "GTG"),
    12: ("CTG", "ATG"),
    13: ("TTG", "ATA", "ATG", "GTG"),
    14: ("ATG",),
    15: ("ATG",),
    16: ("ATG",),
    21: ("ATG", "GTG"),
    22: ("ATG",),
    23: ("ATT", "ATG", "GTG"),
    24: ("TTG", "CTG", "ATG", "GTG"),
    25: ("TTG", "ATG", "GTG"),
    26: ("CTG", "ATG"),
    27: ("ATG",),
    28: ("ATG",),
    29: ("ATG",),
    30: ("ATG",),
    31: ("ATG",),
    32: ("TTG", "CTG", "ATT", "ATC", "ATA", "ATG", "GTG"),
    33: ("TTG", "CTG", "ATG", "GTG"),
}
# Stops of codes in which a codon is read in both ways, and what other tools call the codes they know.
BOTH = {27: ("TGA",), 28: ("TAA", "TAG", "TGA"), 31: ("TAA", "TAG")}
ASSEMBLER_NAMES = {1: "universal", 6: "Tetrahymena", 10: "Euplotes", 12: "Candida"}
PREDICTOR_CODES = (1, 6, 26)


def table(code: int) -> dict[str, str]:
    """codon -> amino acid ('*' for stop); ValueError for a code that isn't known."""
    if code not in CHANGES:
        raise ValueError(f"unknown genetic code {code}")
    return dict(zip(CODONS, STANDARD, strict=True)) | CHANGES[code]


def starts(code: int) -> list[str]:
    table(code)
    return list(STARTS[code])


def stops(code: int) -> list[str]:
    """Codons that may end a frame, those that are also read as an amino acid included."""
    return sorted({*(c for c, a in table(code).items() if a == "*"), *BOTH.get(code, ())})


def code_of(value: int | str) -> int:
    """The code as a number; ValueError for one that isn't a number or isn't known."""
    try:
        code = int(value)
    except (TypeError, ValueError):
        raise ValueError(f"genetic code must be a number: {value!r}") from None
    table(code)
    return code


def assembler_flag(code: int) -> list[str]:
    """Arguments for the transcript assembler: none for its default or a code that it doesn't know."""
    return ["--GENETIC_CODE", ASSEMBLER_NAMES[code]] if code in ASSEMBLER_NAMES and code != 1 else []


def predictor_flag(code: int) -> list[str]:
    return [f"--gcode={code}"] if code in PREDICTOR_CODES and code != 1 else []


def translate(seq: Column, code: int) -> Column:
    """Amino acids of a coding sequence: stop is '*', codons with other letters are 'X', a partial last codon is left off."""
    known = F.create_map(*(F.lit(x) for c, a in sorted(table(code).items()) for x in (c, a)))
    up = F.translate(F.upper(seq), "U", "T")
    codons = F.filter(F.regexp_extract_all(up, F.lit("..."), F.lit(0)), lambda c: F.length(c) == 3)
    return F.array_join(F.transform(codons, lambda c: F.coalesce(F.try_element_at(known, c), F.lit("X"))), "")
