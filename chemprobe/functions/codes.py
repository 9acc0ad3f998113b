"""The byte code of read/reference relationships, and small maps over bases."""

from __future__ import annotations

# One bit for each relationship that a position may have.
BLANK, MATCH, DELET, INS_5, INS_3 = 0x00, 0x01, 0x02, 0x04, 0x08
SUB_A, SUB_C, SUB_G, SUB_T = 0x10, 0x20, 0x40, 0x80
SUB_N, ANY_N, INDEL, EVERY = 0xF0, 0xF1, 0x0E, 0xFF

SUBSTITUTION = {"A": SUB_A, "C": SUB_C, "G": SUB_G, "T": SUB_T}
#: What the two ends of an insertion and all matches share: these count as matches.
MATCH_INS5 = MATCH | INS_5

# The FLAG bits of an alignment record.
FLAGS = {
    "paired": 1, "proper": 2, "unmap": 4, "munmap": 8, "rev": 16, "mrev": 32,
    "first": 64, "second": 128, "secondary": 256, "qcfail": 512, "dup": 1024, "supp": 2048,
}

#: Defaults of the quality threshold: Phred 25 in the Phred+33 encoding.
PHRED_ENCODING, MIN_PHRED = 33, 25


def low_quality(base: str) -> int:
    """What a base call below the threshold may be: anything but a substitution to the reference base."""
    return ANY_N ^ SUBSTITUTION[base]


def glyph(code: int) -> str:
    """One character for a byte, `?` for any that is not a single relationship."""
    signs = {BLANK: ".", MATCH: "~", DELET: "/", INS_5: "{", MATCH | INS_5: "{", INS_3: "}", MATCH | INS_3: "}", SUB_A: "A", SUB_C: "C", SUB_G: "G", SUB_T: "T"}
    return signs.get(code, "?")
