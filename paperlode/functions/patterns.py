r"""Regular expressions in Java's dialect.

Flags: U makes \d, \s and \w Unicode-aware, i with U folds case by Unicode, d lets only \n end a
line, for ``.`` and ``$``.
"""

# What counts as a heading, a reference, a page label and a dosing signal.
SECTION = r"(?iUd)^SECTION\s+[A-Z]+$"
NUMBERED = r"(?Ud)^\s*(\d+(?:\.\d+){0,3})\.?\s+(.+?)\s*$"
#: What each line that is a heading begins with.
HEADING_HINT = r"(?U)^\s*[\dSs\u017F]"
TOC_ENTRY = r"(?Ud)^\s*(\d+(?:\.\d+){0,3})\.?\s+(.+?)\s+(\d+)\s*$"
TOC_TITLE = "TABLE OF CONTENTS"
PAGE_LABEL = r"(?iUd)\bPAGE\s+([0-9]+)\b"
SIGNALS = {
    "strength": r"(?iUd)\b\d+(?:\.\d+)?\s*(?:mcg|mg|g|ml|iu|%)(?:\s*/\s*(?:\d+(?:\.\d+)?\s*)?(?:mcg|mg|g|ml|kg))?",
    "timing": r"(?iUd)\b(?:stat|\d+\s*hourly|for\s+\d+\s+days?)\b",
    "band": r"(?iUd)\b(?:age|weight)?\s*\d+(?:\.\d+)?\s*[-–]\s*\d+(?:\.\d+)?\s*(?:months?|years?|kg)\b",
    "route": r"(?iUd)\b(?:oral|IM|IV|SC|topical|inhaled|rectal)\b",
}
#: The same for ASCII texts, where U changes nothing; positions are told by one character before \b is tried.
ASCII_SIGNALS = {
    name: lead + pattern.replace("(?iUd)", "").replace("–", "")
    for (name, pattern), lead in zip(SIGNALS.items(), [r"(?i)(?=[0-9])", r"(?i)(?=[sf0-9])", r"(?i)(?=[aw\s0-9])", r"(?i)(?=[oistr])"])
}
#: Found in each ASCII line that has a signal, and in few others.
ASCII_HINT = r"(?i)[0-9]\s*(?:m|g|iu|%|hour|day|-)|[soitr](?<=s)tat|[soitr](?:(?<=o)ral|(?<=i)(?:[mv]\b|nhaled)|(?<=s)c\b|(?<=t)opical|(?<=r)ectal)"
TOKEN = r"(?U)[A-Z]+|\d+(?:\.\d+)?|[%/]"
PROTECTED = [
    "MG", "MCG", "G", "ML", "IU", "KG", "IM", "IV", "SC", "ORAL", "TOPICAL", "INHALED", "RECTAL", "STAT", "HOURLY",
    "DAY", "DAYS", "MONTH", "MONTHS", "YEAR", "YEARS", "AGE", "WEIGHT", "NOT", "NO", "REFER", "CONTRAINDICATED",
]
#: Protected tokens of an ASCII text: numbers, fixed words, and words before a number.
ASCII_PROTECTED = r"[0-9]+(?:\.[0-9]+)?|(?<![A-Z])(?:(?:%s)(?![A-Z])|[A-Z]++(?=[^A-Z0-9%%/]*+[0-9]))" % "|".join(PROTECTED)
