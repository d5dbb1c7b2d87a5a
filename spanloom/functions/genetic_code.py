"""the public NCBI translation tables."""

from __future__ import annotations

# Table 1 in the order TTT, TTC, TTA, TTG, TCT ... GGG, and how the other tables differ from it.
STANDARD = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
DIFFERENCES = {
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
    16: {"TAG": "L"},
    21: {"TGA": "W", "ATA": "M", "AGA": "S", "AGG": "S", "AAA": "N"},
    22: {"TCA": "*", "TAG": "L"},
    23: {"TTA": "*"},
    24: {"AGA": "S", "AGG": "K", "TGA": "W"},
    25: {"TGA": "G"},
    26: {"CTG": "A"},
    27: {"TAG": "Q", "TAA": "Q", "TGA": "W"},
    29: {"TAA": "Y", "TAG": "Y"},
    30: {"TAA": "E", "TAG": "E"},
    31: {"TGA": "W", "TAG": "E", "TAA": "E"},
    33: {"TAA": "Y", "TGA": "W", "AGA": "S", "AGG": "K"},
}


def table(number: int = 1) -> dict[str, str]:
    """Codon to amino acid."""
    codons = [a + b + c for a in "TCAG" for b in "TCAG" for c in "TCAG"]
    return dict(zip(codons, STANDARD, strict=True)) | DIFFERENCES[number]


def stops(number: int = 1) -> list[str]:
    return sorted(c for c, a in table(number).items() if a == "*")
