"""Fixed values and character classes shared by the column functions.

Character classes are written so that Java regex and RE2 read them alike.
"""

# --- fixed values: standard one-letter correspondences, Latin -> Cyrillic ---
STANDARD_LETTERS = {
    "a": "а", "b": "б", "c": "ц", "č": "ч", "d": "д", "e": "е", "ě": "є", "f": "ф", "g": "г",
    "h": "х", "i": "и", "j": "ј", "k": "к", "l": "л", "m": "м", "n": "н", "o": "о", "p": "п",
    "r": "р", "s": "с", "š": "ш", "t": "т", "u": "у", "v": "в", "y": "ы", "z": "з", "ž": "ж",
}
# --- fixed values: two-letter correspondences ---
STANDARD_DIGRAPHS = {"dž": "дж", "lj": "љ", "nj": "њ"}
# --- fixed values: etymological letters and the plain spelling they reduce to ---
ETYMOLOGICAL_LETTERS = {
    "ę": "e", "ų": "u", "å": "a", "ė": "e", "ȯ": "o", "ć": "č", "đ": "dž", "ò": "o", "ĺ": "l",
    "ľ": "l", "ń": "n", "ň": "n", "ŕ": "r", "ř": "r", "ť": "t", "ď": "d", "ś": "s", "ź": "z",
}
# --- fixed values: block reasons ---
REASON_ROMAN = "unlisted_structural_roman_identity"
REASON_UNMAPPED = "unmapped_or_ambiguous_letter"
REASON_SCRIPT = "wrong_script_in_latin_source"
MAPPING_REASONS = (REASON_UNMAPPED, REASON_SCRIPT)
# --- fixed values: Roman numeral grammar (optional D before C, L before X, V before I) ---
ROMAN = r"M{0,3}(?:CM|CD|D?C{0,3})(?:XC|XL|L?X{0,3})(?:IX|IV|V?I{0,3})"
# --- fixed values: typographic units, and their spelling once projected ---
DIMENSION_UNITS = ("filll", "fill", "fil", "pt", "pc", "in", "bp", "cm", "mm", "dd", "cc", "sp", "em", "ex", "mu")
PROJECTED_UNITS = ("филлл", "филл", "фил", "пт", "пц", "ин", "бп", "цм", "мм", "дд", "цц", "сп", "ем", "екс", "му")
# --- fixed values: exact literals that are identities, not prose ---
IDENTITY_LITERALS = ("q. e. d.", "q.e.d.", "Q. E. D.", "Q.E.D.")
# --- fixed values: fatal log phrases ---
FATAL_PHRASES = (
    "! LaTeX Error", "Undefined control sequence", "Emergency stop", "Fatal error",
    "TeX capacity exceeded", "Missing character:", "There were undefined references",
    "There were undefined citations",
)
# --- fixed values: secret-like patterns ---
SECRET_PATTERNS = (
    ("ghp", r"ghp_[A-Za-z0-9]{20,}"),
    ("github_pat", r"github_pat_[A-Za-z0-9_]{20,}"),
    ("bearer", r"(?i)Authorization\s*:\s*Bearer\s+[A-Za-z0-9._-]{20,}"),
    ("access_token", r"(?i)access_token\s*=\s*[A-Za-z0-9._-]{20,}"),
)
# --- fixed values: personal-name grammar ---
NAME_CAPITAL = "[A-ZÀ-ÖØ-ÞČĆĐĚĽĹŃŇŘŚŠŤŹŽÅȦÉÜÖÄÆŒ]"
NAME_PARTICLES = "(?:van|von|der|de|des|du|della|di|la|le)"
# --- fixed values: what may stand beside a lone I, V or M that is a label ---
LABEL_INITIALS = "[A-ZÀ-ÖØ-ÞČĆĐĚŠŽ]"
ROMAN_DIGITS = "[IVXLCDM]"
DASHES = "(?:---|--|–|-|,|/)"
# --- fixed values: roles ---
VISIBLE_ROLES = ("visible_prose", "visible_math_text", "visible_metadata")
PROTECTING_PREFIXES = ("PROTECT", "PRESERVE")

# Letter run: letters, letter numbers and other numbers; no marks, digits or underscore.
LETTER = r"\p{L}\p{Nl}\p{No}"
LETTER_RUN = f"[{LETTER}]+"
ANY_RUN = f"[{LETTER}]+|[^{LETTER}]+"
# Unicode white space and line breaks, spelled out because \s differs between engines.
SPACE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BREAK = r"\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}"
# Every character that is not a line break, commonest ranges first: a short positive class beats a negated one.
NOT_BREAK = r"\x{20}-\x{7e}\x{a0}-\x{2027}\t\x{202a}-\x{10ffff}\x{00}-\x{08}\x{0e}-\x{1b}\x{1f}\x{7f}-\x{84}\x{86}-\x{9f}"
PHYSICAL_LINE = rf"[{NOT_BREAK}]*+(?:\r\n|[{BREAK}])|[{NOT_BREAK}]++"
TEX_SPACE = rf"(?:\\[ ,;:]|~|[{SPACE}])"


def _both_cases(table: dict[str, str]) -> dict[str, str]:
    return {**table, **{k.upper(): v.upper() for k, v in table.items()}}


# The long s folds to s, so it is a supported spelling of s.
SUPPORTED = "".join(_both_cases({**STANDARD_LETTERS, **ETYMOLOGICAL_LETTERS})) + "ſ"
ONE_TO_ONE_REDUCTIONS = _both_cases({k: v for k, v in ETYMOLOGICAL_LETTERS.items() if len(v) == 1})
LATIN_TO_CYRILLIC = {**_both_cases(STANDARD_LETTERS), "ſ": STANDARD_LETTERS["s"]}
UNIT_ALTERNATION = "|".join(DIMENSION_UNITS)
PROJECTED_UNIT_ALTERNATION = "|".join(PROJECTED_UNITS)
