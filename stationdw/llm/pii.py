"""Surrogates for personal data and secrets: keyed, type-consistent, distinct and coreferent.

A detected entity is replaced by another value of its type and format: letters by letters of the
same script and kind, digits by digits, valid card numbers by valid card numbers, public
addresses by public addresses, given names by names of the same gender and script. The value
comes from a keyed permutation of all values of that format (a Feistel network over mixed-radix
numbers with cycle walking), so different entities get different surrogates by construction and
the same entity gets the same one in every document.

Two things a permutation cannot promise are checked over the whole corpus: that no surrogate is
itself an entity of the corpus, and that names drawn from the name lists stay distinct. Entities
that fail draw again (with the attempt as tweak) until no check fails. Only those few exceptions
are joined back to documents; every other surrogate is recomputed where it is needed.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, keeps_tables, stage

# ---- keyed permutation ----------------------------------------------------------------------


def permute(key: bytes, tweak: str, value: int, size: int) -> int:
    """A keyed permutation of range(size): eight Feistel rounds on the next even number of bits,
    walked until the value is in range."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for i in range(8):
            block = hashlib.shake_128(key + f"{tweak}|{size}|{i}|".encode()
                                      + right.to_bytes(width, "big")).digest(width)
            left, right = right, left ^ (int.from_bytes(block, "big") & mask)
        value = left << half | right
        if value < size:
            return value


#: Alphabets within which a letter may change: script and case, vowels apart from consonants.
ALPHABETS = (
    "0123456789",
    "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
    "àáâãäåæèéêëìíîïòóôõöøùúûü", "çñðþßýÿ", "ÀÁÂÃÄÅÆÈÉÊËÌÍÎÏÒÓÔÕÖØÙÚÛÜ", "ÇÑÐÞÝ",
    "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
)
_ALPHABET_OF = {c: a for a in ALPHABETS for c in a}
#: Signs that one step of the permutation takes; longer values are chained.
_STEP = 64


@lru_cache(maxsize=256)
def _kin(script: str, category: str, row: int) -> str:
    """Letters (or digits) of a script and case in one row of 128 code points, those whose case
    changes to more than one sign and back left out."""
    out = []
    for n in range(row << 7, (row + 1) << 7):
        c = chr(n)
        if (unicodedata.category(c) == category and unicodedata.name(c, "").split(" ")[0] == script
                and len(c.upper()) == len(c.lower()) == len(c.casefold()) == 1
                and (category != "Ll" or c.casefold() == c) and c not in _ALPHABET_OF):
            out.append(c)
    return "".join(out)


def _alphabet(c: str) -> str | tuple[int, int] | None:
    """What a sign may change to: its listed alphabet, a range of a large script, or its own
    script, case and row of Unicode; None for signs that stay."""
    if (known := _ALPHABET_OF.get(c) or _letter_range(c)) or c.isascii():
        return known
    category = unicodedata.category(c)
    if category in ("Lu", "Ll", "Lo", "Lm", "Lt", "Nd"):
        kin = _kin(unicodedata.name(c, "").split(" ")[0], category, ord(c) >> 7)
        if c in kin and len(kin) > 1:
            return kin
        return "abcdefghijklmnopqrstuvwxyz" + c  # alone of its kind: may become a plain letter
    return None
_WIDE = ((0x4E00, 0x9FFF), (0x3041, 0x3096), (0x30A1, 0x30FA), (0xAC00, 0xD7A3))


def _letter_range(c: str) -> tuple[int, int] | None:
    return next(((a, b) for a, b in _WIDE if a <= ord(c) <= b), None)


def permute_text(key: bytes, tweak: str, text: str, alphabet: str | None = None) -> str:
    """Every letter and digit changes within its alphabet (or within ``alphabet``); other signs
    stay. Values of one pattern are permuted among themselves.

    A value is permuted ``_STEP`` signs at a time, so the time grows with its length. The steps
    of a longer one are chained, forward and then backward: each depends on the results of all
    before it, which still is a permutation, and the whole result depends on every sign.
    """
    parts = [text[i:i + _STEP] for i in range(0, len(text), _STEP)] or [""]
    if len(parts) == 1:
        return _permute_part(key, tweak, text, alphabet)
    for way in ("forward", "backward"):
        seen, out = hashlib.sha256(key), []
        for n, part in enumerate(parts):
            out.append(_permute_part(key, f"{tweak}|{way}|{n}|{len(text)}|{seen.hexdigest()}", part,
                                     alphabet))
            seen.update(out[-1].encode())
        parts = out[::-1]
    return "".join(parts)


def _permute_part(key: bytes, tweak: str, text: str, alphabet: str | None) -> str:
    if alphabet is not None:
        sets = [alphabet if c in alphabet else None for c in text]
    else:
        sets = list(map(_alphabet, text))
    radix = [len(s) if isinstance(s, str) else s[1] - s[0] + 1 if s else 1 for s in sets]
    value, size = 0, 1
    for c, s, r in zip(text, sets, radix):
        if s:
            value = value * r + (s.index(c) if isinstance(s, str) else ord(c) - s[0])
            size *= r
    pattern = ",".join(str(s) if s else c for c, s in zip(text, sets))
    value = permute(key, f"{tweak}|{hashlib.sha256(pattern.encode()).hexdigest()[:16]}", value,
                    size)
    out = []
    for c, s, r in zip(reversed(text), reversed(sets), reversed(radix)):
        if s:
            value, digit = divmod(value, r)
            c = s[digit] if isinstance(s, str) else chr(s[0] + digit)
        out.append(c)
    return "".join(reversed(out))


# ---- entities -------------------------------------------------------------------------------

#: Given names by script and gender (a small list; names that run out are spelled anew).
NAMES = {
    "latin": {"m": "James Robert Michael David Richard Thomas Daniel Paul Mark George Peter Carlos "
                   "Hans Pierre Luis Karl".split(),
              "f": "Mary Linda Susan Karen Sarah Nancy Laura Anna Emma Julia Maria Elena Greta "
                   "Claire Sofia Ingrid".split()},
    "cyrillic": {"m": "Иван Пётр Павел Сергей Андрей Дмитрий Олег Борис".split(),
                 "f": "Анна Мария Елена Ольга Ирина Наталья Татьяна Вера".split()},
    "greek": {"m": "Γιώργος Νίκος Κώστας Δημήτρης Παύλος Αλέξης".split(),
              "f": "Μαρία Ελένη Αννα Σοφία Κατερίνα Ειρήνη".split()},
}
#: Given names that the lists don't hold are put together: syllables and an ending by gender.
SYLLABLES = {"latin": ("bcdfghjklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу"),
             "greek": ("βγδκλμνπρστφ", "αεηιο")}
ENDINGS = {"latin": {"m": "bert mond ron ton us vin".split(), "f": "bella dia lina nette rina ssa".split()},
           "cyrillic": {"m": "ан ей ислав ор".split(), "f": "ина ия ислава ана".split()},
           "greek": {"m": "ας ης ος ων".split(), "f": "α ία ούλα ω".split()}}
#: Forms of address and the gender they tell (u: none).
TITLES = {"Mr": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Господин": "m", "Κύριος": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f",
          "Señora": "f", "Señorita": "f", "Госпожа": "f", "Κυρία": "f", "Sr": "m", "Don": "m",
          "Sra": "f", "Srta": "f", "Mlle": "f", "Mademoiselle": "f", "Fräulein": "f", "Doña": "f",
          "Dr": "u", "Prof": "u", "Professor": "u", "Doctor": "u", "Doktor": "u"}

_TITLE = "|".join(sorted(TITLES, key=len, reverse=True))
_NAME = re.compile(rf"\b((?:(?:{_TITLE})\.? )*(?:{_TITLE}))(\.? )"
                   r"([^\W\d_a-zà-ÿа-яα-ω][^\W\d_]+)(?: ([^\W\d_a-zà-ÿа-яα-ω][^\W\d_]+))?")
_LOCAL = re.compile(r"[^\w.+%-]")
_DOMAIN = re.compile(r"[^\W_][\w-]*(?:\.[^\W_][\w-]*)+")
_LETTERS = re.compile(r"(?<!\w)[^\W\d_]++(?![^\W_])")
_SECRET = re.compile(r"""(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"""
                     r"""\s*[=:]\s*["']?([^\s"'!,;]{6,})""")
_AWS = re.compile(r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b")
#: Secrets known by their own form; what tells the form stays, groups change.
_TOKENS = (
    ("gh", re.compile(r"\b(?:gh[pousr]_|github_pat_)(\w{20,})")),
    ("eyJ", re.compile(r"(?<![\w-])eyJ([\w-]{8,})\.(?:eyJ)?([\w-]{8,})\.([\w-]{8,})")),
    ("PRIVATE KEY", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----(?:"
                               r"((?:[^-]|-(?!----))+)(?=-----END)|((?:\s+[A-Za-z0-9+/=]{16,})+))")),
    ("glpat-", re.compile(r"\bglpat-([\w-]{20,})")),
    ("xox", re.compile(r"\bxox[abeoprs]-([\w-]{10,})")),
    ("sk", re.compile(r"\bsk(?:-|_live_|_test_)([\w-]{20,})")),
    ("AIza", re.compile(r"\bAIza([\w-]{35})(?![\w-])")),
    ("hf_", re.compile(r"\bhf_([A-Za-z0-9]{30,})")),
    ("npm_", re.compile(r"\bnpm_([A-Za-z0-9]{36})\b")),
    ("earer", re.compile(r"\b[Bb]earer\s+([\w.~+/-]{16,}=*)")),
)
_GAP = r"[ .\-\u00a0\u202f\u2011]"
# stretches that may hold numbers of any kind; what begins and ends the numbers in them
_DIGITS = re.compile(r"[\d().+ \-/\u00a0\u202f\u2011]{7,}")
_FIRST = re.compile(r"[+(\d]")
#: What tells that a bare count of digits is a phone number.
_PHONE_WORD = re.compile(r"(?i)\b(?:tel|phone|telephone|call|fax|mobil|mobile|cell|text|sms|whatsapp|ring|"
                         r"hotline|contact|handy|telefon|fon|t[ée]l[ée]phone|t[ée]l[ée]fono|m[óo]vil|"
                         r"appele[rz]|portable|anruf|rufen?|llame|llamar)\b[^\d\n]{0,16}\Z")
_NANP = re.compile(r"1?[2-9]\d\d[2-9]\d{6}")
_IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)"
                 r"(?!\w|\.\d)")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
_CARD = re.compile(r"(?<![\w-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})"
                   r"(?![\w-])")
_PHONE = re.compile(r"(?<![\w.])(\+\d{1,3}[ .-]?)?(\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]"
                    r"\d{3,4}(?![\w-])")
# Any grouping; the digits are counted, and other kinds of numbers told apart, by _phone_start.
_PHONE_ABROAD = re.compile(rf"(?<![\w+])(?:\+|00{_GAP}?)[1-9](?:\)?[/]?{_GAP}?\(?\d){{6,14}}"
                           r"(?![\w-])")
_PHONE_ANY = re.compile(rf"(?<![\w.+/-])(?<!\d,)\(?\d(?:\)?[/]?{_GAP}?\(?\d){{6,14}}"
                        r"(?![\w/-]|[.,]\d)")
_DATE = re.compile(r"(?<!\d)(?:(?:1[89]|20)\d\d(\D?)(?:0?[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|"
                   r"(?:0?[1-9]|[12]\d|3[01])(\D)(?:0?[1-9]|[12]\d|3[01])\2(?:1[89]|20)\d\d)"
                   r"(?!\d)")
_YEAR = re.compile(r"(?:1[89]|20)\d\d")
#: Country codes of one and two digits; all others have three.
_SHORT_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 "
                         "56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}(?:[0-9A-Fa-f]{1,4})?(?![\w:]|\.\d)")
_IBAN = re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}")
_HEX = re.compile(r"[0-9a-f]+|[0-9A-F]+")


def luhn(digits: str) -> int:
    """The check digit that makes ``digits`` + check digit valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _phone_start(mention: str) -> int | None:
    """Where the subscriber's number begins in a phone number, after the country code and the
    trunk 0, which stay; None for what is no phone number."""
    digits = [i for i, c in enumerate(mention) if c.isdigit()]
    text = "".join(mention[i] for i in digits)
    skip = 0
    if mention[0] == "+" or text.startswith("00"):
        skip = 0 if mention[0] == "+" else 2
        if not 7 <= len(text) - skip <= 15:
            return None
        skip += next((n for n in (1, 2) if text[skip:skip + n] in _SHORT_CODES), 3)
    else:
        groups = re.findall(r"\d+", mention)
        if not 7 <= len(text) <= 15 or any(len(g) < 2 for g in groups[1:]) \
                or _DATE.search(mention) or all(_YEAR.fullmatch(g) for g in groups):
            return None
        if groups[0][0] != "0" and "(" not in mention:
            thousands = len(groups[0]) < 3 and all(len(g) == 3 for g in groups[1:])
            decimal = len(groups) == 2 and "." in mention
            if len(groups) > 1 and (thousands or decimal or "/" in mention) \
                    and not _PHONE.fullmatch(mention):
                return None
    if text[skip] == "0" and len(text) - skip > 7:
        skip += 1
    return digits[skip]


def _iban_end(mention: str) -> int | None:
    """Where a valid IBAN that begins the mention ends, by its check digits."""
    n = 0
    for i, c in enumerate(mention, 1):
        n += c != " "
        if c != " " and n >= 15 and (i == len(mention) or not mention[i].isalnum()) \
                and int("".join(str(int(x, 36)) for x in _iban_turned(mention[:i]))) % 97 == 1:
            return i
    return None


def _iban_turned(mention: str) -> str:
    plain = mention.replace(" ", "")
    return plain[4:] + plain[:4]


def _emails(text: str) -> list[tuple[int, int, str, str]]:
    """Every address, found from its @ outward: each sign is looked at once."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and not _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            out.append((start, free, "email", text[start:free].lower()))
        at = text.find("@", free)
    return out


def _numbers(text: str):
    """(start, end) of stretches that begin and end as numbers do."""
    for run in _DIGITS.finditer(text):
        first = _FIRST.search(text, *run.span())
        end = run.end()
        while first and end > first.start() and not text[end - 1].isdigit():
            end -= 1
        if first and end - first.start() >= 7:
            yield first.start(), end


def _bare_names(text: str, titled: list[tuple[int, int, str, str]]
                ) -> list[tuple[int, int, str, str]]:
    """Mentions without a title, capitalised, of names that the text has behind one. A name that is
    both is a given name before a family name, and else a family name."""
    given: dict[str, str] = {}
    family: set[str] = set()
    for _, _, kind, canonical in titled:
        if kind == "family":
            family.add(canonical)
        else:
            given.setdefault(canonical, kind)
    if not titled:
        return []
    taken = {s[0] for s in titled}
    hits = [(m, word) for m in _LETTERS.finditer(text)
            if ((word := m.group().casefold()) in given or word in family)
            and m.start() not in taken and not m.group().islower()]
    starts = {s[0] for s in titled if s[2] == "family"} | {
        m.start() for m, word in hits if word in family}
    out = []
    for m, word in hits:
        if word in given and (word not in family or text[m.end():m.end() + 1] == " "
                              and m.end() + 1 in starts):
            out.append((*m.span(), given[word], word))
        elif word in family:
            out.append((*m.span(), "family", word))
    return out


def find(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical form) of every entity, in order, without overlaps. Equal
    entities have equal canonical forms however they are written."""
    if not text:
        return []
    spans: list[tuple[int, int, str, str]] = []
    low = text.lower()
    known = [(*m.span(g), "secret", m.group(g)) for sign, pattern in _TOKENS if sign in text
             for m in pattern.finditer(text) for g in range(1, pattern.groups + 1) if m.group(g)]
    spans += known
    inside = bytearray(len(text))
    for a, b, *_ in known:
        inside[a:b] = b"\1" * (b - a)
    if any(w in low for w in ("passw", "pwd", "secret", "token", "key")):
        for m in _SECRET.finditer(text):
            value = m.group(1)
            if any(inside[m.start(1):m.end(1)]):
                continue  # the same secret is known by its form elsewhere, too
            spans.append((*m.span(1), "secret", value.lower() if _HEX.fullmatch(value) else value))
    if "AKIA" in text or "ASIA" in text:
        spans += [(*m.span(), "secret", m.group()) for m in _AWS.finditer(text)]
    if "@" in text:
        spans += _emails(text)
    if ":" in text:
        for m in _IPV6.finditer(text):
            try:
                address = ipaddress.IPv6Address(m.group())
            except ValueError:
                continue
            if int(address) > 1 and (any(c.isdigit() for c in m.group())
                                     or len(re.findall(r"\w+", m.group())) > 2):
                spans.append((*m.span(), "ipv6", str(address)))
    for m in _IBAN.finditer(text):
        if end := _iban_end(m.group()):
            spans.append((m.start(), m.start() + end, "iban", m.group()[:end].replace(" ", "")))
    whole: set[int] = set()  # where a phone number of ten digits begins
    for first, end in _numbers(text):
        a, b = max(0, first - 1), end + 2
        for kind, pattern in (("ip", _IP), ("ssn", _SSN), ("card", _CARD), ("phone", _PHONE),
                              ("phone", _PHONE_ABROAD), ("phone", _PHONE_ANY)):
            for m in pattern.finditer(text, a, b):
                digits = re.sub(r"\D", "", m.group())
                if kind == "ip":
                    spans.append((*m.span(), kind, ".".join(str(int(x)) for x in
                                                            m.group().split("."))))
                elif kind == "phone":
                    at = _phone_start(m.group())  # the country code and a trunk 0 stay
                    if at is not None and m.group().isdigit() and digits[0] != "0" \
                            and not _NANP.fullmatch(digits) \
                            and not _PHONE_WORD.search(text, max(0, m.start() - 40), m.start()):
                        continue  # a count or an id
                    if at is not None:
                        start = m.start() + at
                        if pattern is not _PHONE and start in whole:
                            continue  # a whole number already; what follows is another
                        spans.append((start, m.end(), kind,
                                      re.sub(r"\D", "", text[start:m.end()])))
                        if len(spans[-1][3]) == 10:
                            whole.add(start)
                elif kind != "card" or len(digits) > 15 or text[m.start() - 1:m.start()] != "+":
                    spans.append((*m.span(), kind, digits))
    if any(t in text for t in TITLES):
        first = len(spans)
        for m in _NAME.finditer(text):
            genders = [TITLES[t] for t in re.findall(_TITLE, m.group(1))]
            gender = next((g for g in genders if g != "u"), "u")
            if m.group(4):
                spans.append((*m.span(3), f"given-{gender}", m.group(3).casefold()))
                spans.append((*m.span(4), "family", m.group(4).casefold()))
            else:
                spans.append((*m.span(3), "family", m.group(3).casefold()))
        spans += _bare_names(text, spans[first:])
    rank = {"secret": 0, "email": 1, "ip": 2, "ipv6": 2, "iban": 2, "card": 3, "ssn": 4}
    if not spans:
        return []
    taken, out = bytearray(len(text)), []
    for s in sorted(spans, key=lambda s: (rank.get(s[2], 5), s[0], -s[1])):
        if not any(taken[s[0]:s[1]]):
            taken[s[0]:s[1]] = b"\1" * (s[1] - s[0])
            out.append(s)
    return sorted(out)


def _script(text: str) -> str | None:
    for name, low, high in (("cyrillic", 0x400, 0x4FF), ("greek", 0x370, 0x3FF)):
        if any(low <= ord(c) <= high for c in text):
            return name
    if any(unicodedata.name(c, "LATIN").startswith("LATIN") for c in text if c.isalpha()):
        return "latin"
    return None  # another script: its own letters are permuted


def keeps(canonical: str, value: str) -> bool:
    """Whether a surrogate gives its original away: it is the same, or has it inside (of one or
    two signs it may, by chance)."""
    return value == canonical or len(canonical) > 2 and canonical in value


def _ip_class(parts: list[int]) -> str:
    a, b = parts[0], parts[1]
    for name, inside in (("10", a == 10), ("127", a == 127), ("192.168", (a, b) == (192, 168)),
                         ("172.16", a == 172 and 16 <= b < 32), ("high", a >= 224),
                         ("zero", a == 0)):
        if inside:
            return name
    return "public"


def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The surrogate, in canonical form, of a canonical entity; at higher attempts another one.
    For given attempt and format it is a permutation (given names of attempt 0 excepted)."""
    tweak = f"{kind}|{attempt}"
    grown = attempt // 8  # a format whose values are used up grows longer
    if kind == "email":
        local, domain = canonical.rsplit("@", 1)
        first, _, rest = domain.partition(".")
        if not re.fullmatch(r"example\.(com|org|net)", rest):  # others move below a reserved one
            first, rest = domain.replace("-", "--").replace(".", "-"), "example.org"
        return (permute_text(key, tweak, local + "x" * grown) + "@"
                + permute_text(key, f"domain|{attempt}", first) + "." + rest)
    if kind == "ip":
        parts = [int(x) for x in canonical.split(".")]
        group, value = _ip_class(parts), int.from_bytes(bytes(parts), "big")
        while True:
            value = permute(key, f"{tweak}|{group}", value, 1 << 32)
            parts = list(value.to_bytes(4, "big"))
            if _ip_class(parts) == group:
                return ".".join(map(str, parts))
    if kind == "ipv6":
        value = int(ipaddress.IPv6Address(canonical))
        free = 125 if value >> 125 == 1 else 112  # unicast stays so, as do other kinds' prefixes
        top, low = value >> free, value & ((1 << free) - 1)
        while True:
            low = permute(key, f"{tweak}|{top}", low, 1 << free)
            if (top << free | low) > 1:
                return str(ipaddress.IPv6Address(top << free | low))
    if kind == "iban":
        body = permute_text(key, f"{tweak}|{canonical[:2]}", canonical[4:])
        rest = int("".join(str(int(x, 36)) for x in body + canonical[:2] + "00")) % 97
        return f"{canonical[:2]}{98 - rest:02d}{body}"
    if kind == "card":
        shift = (int(canonical[-1]) - luhn(canonical[:-1])) % 10  # 0 for valid numbers
        body = canonical[0] + permute_text(key, tweak, canonical[1:-1])
        return body + str((luhn(body) + shift) % 10)
    if kind == "ssn":
        def usable(s):
            return s[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" \
                and s[5:] != "0000"
        value, was = canonical, usable(canonical)
        while True:
            value = permute_text(key, tweak, value)
            if usable(value) == was:
                return value
    if kind == "phone":
        lead = 1 if canonical[0] != "0" else 0  # no number starts to begin with 0
        value = canonical
        while True:
            value = permute_text(key, tweak, value)
            if (value[0] != "0") == bool(lead):
                return value + "1" * grown
    if kind == "secret":
        if not any(map(_alphabet, canonical)):  # nothing in it can change
            return hmac.new(key, f"{tweak}|{canonical}".encode(), hashlib.sha256).hexdigest()
        if canonical[:4] in ("AKIA", "ASIA") and len(canonical) == 20:
            return canonical[:4] + permute_text(key, tweak, canonical[4:],
                                                "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
        if _HEX.fullmatch(canonical):
            return permute_text(key, tweak, canonical + "a" * grown, "0123456789abcdef")
        return permute_text(key, tweak, canonical + "x" * grown)
    if kind.startswith("given-") and (script := _script(canonical)):
        draw = int.from_bytes(hmac.new(key, f"{tweak}|{canonical}".encode(),
                                       hashlib.sha256).digest(), "big")
        gender = kind[-1] if kind[-1] != "u" else "mf"[draw & 1]
        draw >>= 1
        if attempt == 0:
            names = NAMES[script][gender]
            return names[draw % len(names)].casefold()
        heads, vowels = SYLLABLES[script]
        ends, out = ENDINGS[script][gender], ""
        for _ in range(2 + grown):
            draw, a = divmod(draw, len(heads))
            draw, b = divmod(draw, len(vowels))
            out += heads[a] + vowels[b]
        return out + ends[draw % len(ends)]
    return permute_text(key, tweak, canonical + {"latin": "a"}.get(_script(canonical),
                                                                  canonical[-1]) * grown)


def _written(mention: str, kind: str, canonical: str, value: str) -> str:
    """The surrogate written as the mention is: its punctuation, and its case."""
    if kind in ("card", "ssn", "phone"):
        digits = iter(value)
        out = "".join(next(digits, "") if c.isdigit() else c for c in mention)
        return out + "".join(digits)
    if kind == "iban":
        signs = iter(value)
        return "".join(c if c == " " else next(signs) for c in mention)
    if kind == "secret" and canonical == mention:
        return value
    if kind.startswith("given-") or kind == "family":
        return value.upper() if mention.isupper() else value[:1].upper() + value[1:]
    return value.upper() if mention.isupper() else value


@lru_cache(maxsize=1 << 12)
def _first_draw(key: bytes, kind: str, canonical: str) -> str:
    return surrogate(key, kind, canonical)


keeps_tables(__name__, _first_draw.cache_clear)


def replace(text: str | None, key: bytes, drawn: dict[tuple[str, str], int] | None = None
            ) -> tuple[str | None, int]:
    """The text with surrogates, and how many entities were replaced. ``drawn`` holds attempts
    of exceptions, by type and canonical form."""
    found = find(text)
    if not found:
        return text, 0
    out, at = [], 0
    for start, end, kind, canonical in found:
        attempt = (drawn or {}).get((kind, canonical), 0)
        value = (surrogate(key, kind, canonical, attempt) if attempt
                 else _first_draw(key, kind, canonical))
        out += [text[at:start], _written(text[start:end], kind, canonical, value)]
        at = end
    return "".join([*out, text[at:]]), len(found)


# ---- over a corpus --------------------------------------------------------------------------


def _exceptions(mentions: DataFrame, key: bytes) -> DataFrame:
    """``kind, canonical, attempt`` of entities whose first draw failed a check: a surrogate that
    gives its original away, is itself an entity of the corpus, or that another entity has.

    Each round draws again only for entities that failed in the one before; the others' draws
    stay, and new ones are checked against all of them.
    """
    entities = stage(mentions.select("kind", "canonical").distinct(), "entities")

    def draw(batch):
        values = [surrogate(key, k, c, a) for k, c, a in
                  zip(batch["kind"], batch["canonical"], batch["attempt"])]
        return {**{c: batch[c] for c in ("kind", "canonical", "attempt")}, "value": values,
                "told": [keeps(c, v) for c, v in zip(batch["canonical"], values)]}

    settled, drawn = None, entities.withColumn("attempt", F.lit(0))
    while True:
        named = stage(arrow_map(drawn, draw, "kind string, canonical string, attempt int, "
                                             "value string, told boolean"), "surrogates")
        # of equal draws the one of the least canonical form stays, if no older draw is equal
        first = named.groupBy("kind", "value").agg(F.min("canonical").alias("keeper"),
                                                   F.count("*").alias("n")).where("n > 1")
        pair = ["kind", "canonical"]
        bad = [named.where("told").select(*pair),
               named.join(first, ["kind", "value"]).where("canonical <> keeper").select(*pair),
               named.join(entities.select("kind", F.col("canonical").alias("value")),
                          ["kind", "value"], "left_semi").select(*pair)]
        if settled is not None:
            bad.append(named.join(settled, ["kind", "value"], "left_semi").select(*pair))
        failed = stage(reduce(DataFrame.unionByName, bad).distinct(), "collided")
        fine = named.join(failed, pair, "left_anti").select("kind", "canonical", "attempt", "value")
        settled = stage(fine if settled is None else settled.unionByName(fine), "settled")
        if failed.isEmpty():
            return settled.where("attempt > 0").select("kind", "canonical", "attempt")
        drawn = named.join(failed, pair, "left_semi").select(
            *pair, (F.col("attempt") + 1).alias("attempt"))


def surrogates(docs: DataFrame, key: bytes | str = b"corpus", id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with the text's entities replaced, and ``n_entities``.

    Null texts stay null with 0 entities; repeated rows give repeated results, and rows of any
    id, null included, are kept. The same key gives the same surrogates at every run. A column
    ``n_entities`` that is there already is replaced. Time grows with the length of a text.
    """
    key = key.encode() if isinstance(key, str) else key
    docs = docs.drop("n_entities")
    columns = docs.columns
    extra = "n_entities"
    marked = docs.select(docs[text_col].alias("text")).where(F.col("text").isNotNull())

    def mentions(batch):
        out: dict[str, list] = {"th": [], "kind": [], "canonical": []}
        for th, text in zip(batch["th"], batch["text"]):
            for kind, canonical in {s[2:] for s in find(text)}:
                out["th"].append(th)
                out["kind"].append(kind)
                out["canonical"].append(canonical)
        return out

    found = stage(arrow_map(marked.select(F.xxhash64("text").alias("th"), "text"), mentions,
                            "th long, kind string, canonical string"), "mentions")
    again = _exceptions(found, key)
    # a text's exceptions as one row; a written table, so that Spark knows how small it is
    per_text = stage(found.distinct().join(again, ["kind", "canonical"]).groupBy("th").agg(
        F.collect_list(F.struct("kind", "canonical", "attempt")).alias("again")), "exceptions")
    rest = [c for c in columns if c != text_col]
    read = docs.select(docs[text_col].alias("_text"), F.xxhash64(docs[text_col]).alias("th"),
                       *[docs[c].alias(f"_keep_{c}") for c in rest])
    read = read.join(per_text, "th", "left").drop("th")

    def rows(batch):
        texts, counts = [], []
        for text, exceptions in zip(batch["_text"], batch["again"]):
            drawn = {(e["kind"], e["canonical"]): e["attempt"] for e in exceptions or ()}
            new, n = replace(text, key, drawn)
            texts.append(new)
            counts.append(n)
        return {"_text": texts, extra: counts, **{f"_keep_{c}": batch[f"_keep_{c}"] for c in rest}}

    types = {f.name: f.dataType.simpleString() for f in read.schema}
    out = arrow_map(read, rows, ", ".join(
        ["_text string", f"{extra} long", *[f"`_keep_{c}` {types[f'_keep_{c}']}" for c in rest]]))
    return out.select(*[F.col("_text").alias(c) if c == text_col else F.col(f"_keep_{c}").alias(c)
                        for c in columns], F.col(extra))
