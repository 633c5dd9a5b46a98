"""Fixed values of the library chemistry.

These must equal the published chemistry exactly; everything else derives from them.
"""

# --- fixed values -----------------------------------------------------------
READ_STRUCTURE = "B17U12"

# 0-based offsets in read 1: insert base, four convertible bases, two insert bases.
PROBE_OFFSETS = (42, 45, 46, 49, 54, 56, 75)
INSERT_OFFSETS = (42, 56, 75)
CONVERTIBLE_OFFSETS = (45, 46, 49, 54)

LINKER_OFFSET = 57
LINKER_SEQUENCE = "GTAGATGTGTATAAGAGA"

NON_INSERT_LENGTH = 70
EXTENSION_LENGTH = 9
CROP_ONLY_ABOVE = 18
MAX_READ1_LENGTH = 63
MIN_READ1_LENGTH = 20
MIN_READ2_LENGTH = 60
MIN_PROBE_QUALITY = 30
CHIMERIC_THRESHOLD = 2

READ1_ADAPTER_5 = "AGATGTGTATAAGAGAYAG"
READ1_ADAPTER_3 = "CTGTCTCTTATACACATCT"
READ2_ADAPTER_5 = "AGATGTGTATAAGAGACAG"
READ2_ADAPTER_3 = "CTRTCTCTTATACACATCT"
ADAPTER_ERROR_RATE = 0.1
ADAPTER_MIN_OVERLAP = 9

# Strand-specific two-mers that bisulfite-like conversion should have removed.
CHIMERIC_PATTERNS = {
    "forward": ("C[ATC]", "[ATG]G"),
    "reverse": ("[ATG]G", "C[ATC]"),
}

IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T",
    "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}
# ----------------------------------------------------------------------------
