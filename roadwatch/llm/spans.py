"""Personal data in one text: base spans by pattern, candidates for more, and labelers' votes."""

import re
from bisect import bisect_left

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("email_words", "phone_local", "national_id", "iban", "number", "credential", "person")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits: were there one, it would start with the run.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY_BASE = re.compile(r"[0-9@]")

# Gazetteers: small fixed word lists of public knowledge.
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Señor Señora".split()
GIVEN_NAMES = (
    "James Michael Robert William David Richard Joseph Thomas Charles Daniel Jennifer Elizabeth Patricia "
    "Barbara Jessica Margaret Sophie Matthias Wolfgang Stefan Katharina Sabine François Nathalie Philippe "
    "Isabelle Alejandro Carmen Francisco Guadalupe"
).split()
IBAN_COUNTRIES = frozenset("AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split())
TOP_DOMAINS = frozenset("com org net edu gov io de fr es eu uk info".split())
FOR_WORDS = re.compile(
    r"(?i)\b(call|phone|tel|telefon|mobile|fax|mail|e-mail|contact|reach|ssn|social security|iban|account|card|name|"
    r"password|passwd|secret|token|key|login|user|born|address)\b[^\n]{0,12}$"
)
AGAINST_WORDS = re.compile(r"(?i)\b(order|invoice|version|isbn|serial|part|item|page|chapter|figure|table|total|year)\b[^\n]{0,8}$")
CONTEXT = 32

CANDIDATES = (
    ("email_words", re.compile(r"\b[A-Za-z0-9._%+-]{1,64} ?[\[(]?(?:at|AT)[\])]? ?[A-Za-z0-9-]{1,63} ?[\[(]?(?:dot|DOT)[\])]? ?([A-Za-z]{2,6})\b")),
    ("phone_local", re.compile(r"(?<![0-9+])\(?([2-9])[0-9]{2}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")),
    ("national_id", re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")),
    ("iban", re.compile(r"\b([A-Z]{2})[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")),
    ("number", re.compile(r"(?<![0-9A-Za-z])[0-9]{13,19}(?![0-9A-Za-z])")),
    ("credential", re.compile(r"\bAKIA[0-9A-Z]{16}\b|\bgh[opsu]_[A-Za-z0-9]{36}\b|\bAIza[0-9A-Za-z_-]{35}|\b(?i:password|passwd|pwd|secret|token|api[_-]?key) ?[:=] ?\"?[^\s\"]{6,}\"?")),
    ("person", re.compile(rf"\b(?:{'|'.join(TITLES)})\.? [A-Z]\w+(?: [A-Z]\w+)?|\b(?:{'|'.join(GIVEN_NAMES)}) [A-Z]\w+")),
)
# What a text must hold for a candidate of the kind; cheap to look for.
NEEDS = {
    "email_words": re.compile("dot|DOT"),
    "phone_local": ANY_BASE,
    "national_id": ANY_BASE,
    "iban": ANY_BASE,
    "number": ANY_BASE,
    "credential": re.compile("[:=]|AKIA|AIza|gh[opsu]_"),
    "person": re.compile("|".join([*TITLES, *GIVEN_NAMES])),
}
LABELERS = ("checksum", "gazetteer", "context_for", "context_against", "surroundings", "shape")
# Kinds of which a failed checksum proves that a candidate is none.
CHECKED_KINDS = frozenset({"number", "iban"})
KEY_PREFIX = re.compile("AKIA|AIza|gh[opsu]_")
DIGIT_RUN = re.compile("[0-9]+")
N_LENGTHS = 4


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text):
    """The pattern's leftmost matches, found from their signs: linear however long a word is."""
    found, last, sign = [], 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, sign) if start < sign else None
        if match:
            found.append((start, match.end()))
        # The sign itself is in no local part, so no later match reaches back over it.
        last = match.end() if match else sign + 1
        sign = text.find("@", last)
    return found


def base_spans(text):
    """(kind, start, end) of the base kinds, by start and then by kind."""
    if not ANY_BASE.search(text):
        return []
    found = [("email", *span) for span in emails(text)]
    for match in IP.finditer(text):
        parts = [part.lstrip("0") for part in match[0].split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            found.append(("ip", *match.span()))
    for match in CARD.finditer(text):
        digits = [c for c in match[0] if c not in " -"]
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    for match in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in match[0]) <= 15:
            found.append(("phone", *match.span()))
    return sorted(found, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


def _checksum(kind, match):
    if kind == "number":
        return luhn(match[0])
    if kind == "national_id":
        area, group, serial = match.groups()
        return not (area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000")
    if kind == "iban":
        code = match[0].replace(" ", "")
        return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1
    if kind == "credential":
        value = match[0].rstrip('"')
        return True if re.search(r"[0-9a-fA-F]{16,}$", value) or KEY_PREFIX.match(value) else None
    return None


def _gazetteer(kind, match):
    if kind == "iban":
        return match[1] in IBAN_COUNTRIES
    if kind == "email_words":
        return match[1].lower() in TOP_DOMAINS
    if kind == "person":
        return True if any(word in GIVEN_NAMES for word in match[0].split()) else None
    if kind == "credential":
        return True if KEY_PREFIX.match(match[0]) else None
    return None


def _surroundings(kind, before, after):
    """False beside letters and digits, or for a number among other numbers, as in lists and tables."""
    edges = before[-1:] + after[:1]
    if any(c.isalnum() or c in "-_/@" for c in edges):
        return False
    if kind in ("number", "national_id", "phone_local"):
        beside = DIGIT_RUN.findall(before.rpartition("\n")[2]) + DIGIT_RUN.findall(after.partition("\n")[0])
        if len(beside) >= 3:
            return False
    return None


def _shape(kind, match):
    """False for what no one would be given: few different signs, or a plain word as a credential."""
    if kind == "credential":
        if KEY_PREFIX.match(match[0]):
            return True
        value = re.split("[:=]", match[0], maxsplit=1)[-1].strip(' "')
        kinds = sum(any(test(c) for c in value) for test in (str.islower, str.isupper, str.isdigit))
        return kinds >= 2 if len(value) >= 8 or kinds < 2 else None
    return False if len(set(match[0])) <= 4 else None


def votes(text, kind, match):
    """One vote per labeler: True, False or None to abstain."""
    start, end = match.span()
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    return (
        _checksum(kind, match),
        _gazetteer(kind, match),
        True if FOR_WORDS.search(before) else None,
        False if AGAINST_WORDS.search(before) else None,
        _surroundings(kind, before, after),
        _shape(kind, match),
    )


def code_of(kind, length, cast):
    """Kind, length class and votes as one number; there are at most 7 * 4 * 3^6 of them."""
    code = MORE_KINDS.index(kind) * N_LENGTHS + (length > 10) + (length > 16) + (length > 32)
    for vote in cast:
        code = code * 3 + (0 if vote is None else 2 if vote else 1)
    return code


def features_of(code):
    """(kind, length class, votes as -1, 0 or 1) of a code."""
    cast = []
    for _ in LABELERS:
        code, vote = divmod(code, 3)
        cast.append(-1 if vote == 0 else vote - 1)
    kind, length = divmod(code, N_LENGTHS)
    return kind, length, cast[::-1]


def candidates(text, base):
    """(kind, start, end, code) of what may be personal data beside the base spans."""
    found, starts, reach = [], [s[1] for s in base], []
    for span in base:
        reach.append(max(span[2], reach[-1] if reach else 0))
    for kind, pattern in CANDIDATES:
        if not NEEDS[kind].search(text):
            continue
        for match in pattern.finditer(text):
            start, end = match.span()
            earlier = bisect_left(starts, end) - 1
            if earlier < 0 or reach[earlier] <= start:
                found.append((kind, start, end, code_of(kind, end - start, votes(text, kind, match))))
    return found


def merged(base, added):
    """Base spans and those of the added ones that overlap nothing before them, in order."""
    kinds, last, chosen = [*BASE_KINDS, *MORE_KINDS], 0, []
    for span in sorted(added, key=lambda s: (s[1], kinds.index(s[0]))):
        if span[1] >= last:
            chosen.append(span)
            last = span[2]
    return sorted([*base, *chosen], key=lambda s: (s[1], kinds.index(s[0])))


def joined(found):
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)
