"""Replacing personal data by keyed surrogates of the same type and form.

Found are e-mail addresses, phone numbers, network addresses of both kinds, card, account and
social security numbers, values of passwords and keys, keys of well-known services, long
hexadecimal strings, and names of persons after a title or with a known first name. Other
names are not seen: there are lists of the most common ones only, and no model.

A surrogate depends on the key and the entity only, so that the same entity gets the same
one in every text of every run. For each type and form the surrogates are a permutation of
the possible values without fixed points: the values are numbered, shuffled by a keyed
Feistel network, and each is replaced by the next one in the shuffled circle. Different
entities can thus not meet in one surrogate, and none keeps its value. What a value has to
obey, such as check digits, the kind of network or not being a known name, holds for the
surrogate too: those in the circle that do not obey are passed over. That is the collision
check, and it needs no table of what was given out. Letters keep case, script and whether
they are vowels, first names their gender and script.

Null texts stay null and have no entities, empty ones stay empty. Very long texts are read
whole. Repeated rows change alike. Null ids are carried along. An empty table gives an
empty result. Columns other than the text pass through ``replace_entities`` as they are.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import release_memory, ship_package

# Common first names by script and gender.
FIRST_NAMES = {
    "transcribed arabic f": "Fatima Aisha Maryam Zainab Khadija Layla Noura Salma",
    "transcribed arabic m": "Mohammed Ahmed Ali Hassan Hussein Omar Ibrahim Khalid Yusuf Mustafa",
    "transcribed indic f": "Priya Anjali Neha Pooja Sunita Kavita Lakshmi Divya Shreya Meera",
    "transcribed indic m": "Rahul Amit Raj Arjun Vikram Sanjay Anil Suresh Ravi Deepak",
    "arabic f": "فاطمة عائشة مريم زينب خديجة ليلى",
    "arabic m": "محمد أحمد علي حسن حسين عمر إبراهيم خالد يوسف",
    "latin f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa"
    " Margaret Sandra Ashley Emily Donna Michelle Laura Julia Sophie Claire Camille Petra Ursula"
    " Sabine Carmen Lucia Pilar Isabel",
    "latin m": "James Robert John Michael David William Richard Joseph Thomas Charles Christopher"
    " Daniel Matthew Anthony Steven Andrew Kenneth George Kevin Brian Pierre Jacques Olivier"
    " Klaus Jürgen Wolfgang Carlos Miguel Javier Pablo",
    "cyrillic f": "Анна Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Мария Людмила",
    "cyrillic m": "Александр Сергей Дмитрий Андрей Алексей Максим Владимир Иван Михаил Николай",
    "greek f": "Μαρία Ελένη Αικατερίνη Βασιλική Σοφία Γεωργία",
    "greek m": "Γεώργιος Ιωάννης Κωνσταντίνος Δημήτριος Νικόλαος Παναγιώτης",
}
# Common full names in Chinese characters, which no blank parts.
HAN_NAMES = {
    "han f": "王芳 李娜 张敏 王秀英 李秀英 王静 李静 张丽 王丽 刘洋",
    "han m": "王伟 李伟 张伟 刘伟 王强 李强 张强 王磊 李军 张勇",
}
# Titles before names, by the gender they tell.
TITLES = {
    "f": "Mrs Ms Miss Frau Mme Mlle Madame Mademoiselle Señora Señorita Sra Srta Госпожа Κυρία",
    "m": "Mr Sir Herr Monsieur Señor Sr Господин Κύριος",
    "": "Dr Prof Professor Doctor",
}
# Letters that stand for each other, by script; vowels apart from consonants.
ALPHABETS = [
    "0123456789",
    "aeiouy", "bcdfghjklmnpqrstvwxz",
    "AEIOUY", "BCDFGHJKLMNPQRSTVWXZ",
    "àáâäæèéêëìíîïòóôöùúûü", "ñçßšž",
    "ÀÁÂÄÆÈÉÊËÌÍÎÏÒÓÔÖÙÚÛÜ", "ÑÇŠŽ",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ",
    "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
    "αεηιουω", "βγδζθκλμνξπρστφχψ",
    "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
    "بتثجحخدذرزسشصضطظعغفقكلمنه", "اوي",
]
_LATIN = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", *ALPHABETS[5:]]
_HEX = ["0123456789abcdef", "ABCDEF"]
_HEX_UPPER = ["0123456789ABCDEF", "abcdef"]
# Domains set aside for examples, which tell nothing.
RESERVED = re.compile(r"(?:^|\.)(?:example\.(?:com|net|org)|example|test|invalid|localhost)$", re.I)


# --- permutations ----------------------------------------------------------------


class Circle:
    """A keyed circle through the numbers below ``size``, for one type and form."""

    def __init__(self, key: bytes, form: str, size: int) -> None:
        self.key, self.form, self.size = key, form.encode(), size
        bits = max(2, (size - 1).bit_length())
        self.low = bits // 2
        self.high = bits - self.low

    def _noise(self, turn: int, value: int, bits: int) -> int:
        message = b"%d|%d|%d|" % (turn, value, bits) + self.form
        digest = hashlib.shake_256(self.key + b"|" + message).digest((bits + 7) // 8)
        return int.from_bytes(digest) & ((1 << bits) - 1)

    def _shuffle(self, x: int, back: bool) -> int:
        while True:
            high, low = x >> self.low, x & ((1 << self.low) - 1)
            for turn in reversed(range(8)) if back else range(8):
                if turn % 2:
                    low ^= self._noise(turn, high, self.low)
                else:
                    high ^= self._noise(turn, low, self.high)
            x = high << self.low | low
            if x < self.size:
                return x

    def following(self, x: int) -> int:
        place = (self._shuffle(x, False) + 1) % self.size
        return self._shuffle(place, True)


def _number(text: str, alphabets: list[str]) -> tuple[int, int, str, list[tuple[str, str] | str]]:
    """A text as a number, how many there are of its form, and the form."""
    value, size, form, slots = 0, 1, [], []
    for c in text:
        letters = next((a for a in alphabets if c in a), None)
        if letters is None:
            form.append(c)
            slots.append(c)
            continue
        value += letters.index(c) * size
        size *= len(letters)
        form.append(f"<{alphabets.index(letters)}>")
        slots.append((letters, c))
    return value, size, "".join(form), slots


def reshaped(
    key: bytes,
    kind: str,
    text: str,
    alphabets: list[str],
    valid: Callable[[str], bool] = lambda _: True,
) -> str:
    """The next valid text of the same form. A form without another valid text stays."""
    value, size, form, slots = _number(text, alphabets)
    if size < 2:
        return text
    circle = Circle(key, f"{kind}|{form}", size)
    while True:
        value = circle.following(value)
        rest, out = value, []
        for slot in slots:
            if isinstance(slot, str):
                out.append(slot)
            else:
                rest, digit = divmod(rest, len(slot[0]))
                out.append(slot[0][digit])
        found = "".join(out)
        if found == text or valid(found):
            return found


# --- types -------------------------------------------------------------------------


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def email(key: bytes, text: str) -> str:
    name, _, domain = text.rpartition("@")
    new = domain
    if not RESERVED.search(domain):
        host, dot, top = domain.rpartition(".")
        new = reshaped(key, f"domain {top}", host, _LATIN) + dot + top
    return f"{reshaped(key, f'mailbox {domain}', name, _LATIN)}@{new}"


def phone(key: bytes, text: str) -> str:
    """The country code stays, and a North American number stays one."""
    code = re.match(r"\+\d{1,3}(?=[ .(-])", text)
    head = code[0] if code else ""
    american = head == "+1" or (not head and len(_digits(text)) == 10)

    def valid(new: str) -> bool:
        d = _digits(new)
        return not american or len(d) != 10 or (d[0] > "1" and d[3] > "1")

    own = valid(text[len(head) :])
    return head + reshaped(
        key, f"phone {head} {own}", text[len(head) :], ["0123456789"], lambda x: valid(x) == own
    )


def network(key: bytes, text: str) -> str:
    def kind(address: str) -> tuple:
        ip = ipaddress.ip_address(address)
        return ip.is_private, ip.is_multicast, ip.is_reserved, ip.is_loopback, ip.is_unspecified

    own, value = kind(text), int(ipaddress.ip_address(text))
    circle = Circle(key, f"network {own}", 2**32)
    while True:
        value = circle.following(value)
        new = str(ipaddress.ip_address(value))
        if new == text or kind(new) == own:
            return new


def network6(key: bytes, text: str) -> str:
    """A public address anywhere among public ones; of others the first half stays."""

    def kind(value: int) -> tuple:
        ip = ipaddress.IPv6Address(value)
        return ip.is_private, ip.is_multicast, ip.is_reserved, ip.is_link_local, ip.is_global

    value = int(ipaddress.IPv6Address(text))
    own = kind(value)
    free = 128 - 16 if ipaddress.IPv6Address(value).is_global else 64
    head, rest = value >> free, value & ((1 << free) - 1)
    circle = Circle(key, f"network6 {own} {head}", 1 << free)
    while True:
        rest = circle.following(rest)
        new = head << free | rest
        if new == value or kind(new) == own:
            break
    ip = ipaddress.IPv6Address(new)
    spelled = ip.exploded if text.lower() == ipaddress.IPv6Address(text).exploded else ip.compressed
    return spelled.upper() if text == text.upper() else spelled


def card(key: bytes, text: str) -> str:
    """Issuer digit and check digit stay right; wrong check digits stay wrong."""
    right = _luhn(_digits(text))
    return text[0] + reshaped(
        key, f"card {text[0]} {right}", text[1:], ["0123456789"],
        lambda x: _luhn(text[0] + _digits(x)) == right,
    )


def _ssn_like(x: str) -> bool:
    return x[:3] not in ("000", "666") and x[0] != "9" and x[4:6] != "00" and x[7:] != "0000"


def social(key: bytes, text: str) -> str:
    own = _ssn_like(text)
    return reshaped(key, f"social {own}", text, ["0123456789"], lambda x: _ssn_like(x) == own)


def _iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def account(key: bytes, text: str) -> str:
    """The same whether it is written in groups or not; blanks stay where they are."""
    plain = text.replace(" ", "")
    country, rest = plain[:2], plain[4:]
    new = reshaped(key, f"account {country}", rest, ["0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"])
    signs = iter(country + _iban_check(country, new) + new)
    return "".join(c if c == " " else next(signs) for c in text)


# How keys of well-known services begin.
_KEY_HEAD = re.compile(r"AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-")


def secret(key: bytes, text: str) -> str:
    """What tells whose key it is stays."""
    found = _KEY_HEAD.match(text)
    head, rest = (found[0], text[found.end() :]) if found else ("", text)
    return head + reshaped(key, f"secret {head}".strip(), rest, _hex(rest) or _LATIN)


def _hex(text: str) -> list[str] | None:
    if not re.fullmatch(r"[0-9a-fA-F]+", text):
        return None
    return _HEX_UPPER if text == text.upper() else _HEX


def full_name(key: bytes, text: str) -> str:
    for group, names in HAN_NAMES.items():
        listed = names.split()
        if text in listed:
            return listed[Circle(key, f"full {group}", len(listed)).following(listed.index(text))]
    return text


_LISTED = {n.casefold() for names in FIRST_NAMES.values() for n in names.split()}


def first_name(key: bytes, text: str, gender: str) -> str:
    for group, names in FIRST_NAMES.items():
        listed = names.split()
        for spelled in (str, str.upper):
            same = [spelled(n) for n in listed]
            if text in same:
                return same[Circle(key, f"first {group}", len(same)).following(same.index(text))]
    return surname(key, text, f"first {gender}")


def surname(key: bytes, text: str, kind: str = "last") -> str:
    return reshaped(
        key, kind, text, ALPHABETS, lambda x: not _LISTED & set(x.casefold().split())
    )


def person(key: bytes, text: str) -> str:
    """Title as it is, a listed first name for another of its gender, and other parts."""
    out, gender, named = [], "", False
    for part in re.split(r"(\s+|\.)", text):
        title = next((g for g, t in TITLES.items() if part in t.split()), None)
        if title is not None and not named:
            gender = title
            out.append(part)
        elif part.strip(" .\t\n"):
            listed = part.casefold() in _LISTED
            out.append(first_name(key, part, gender) if listed else surname(key, part))
            named = True
        else:
            out.append(part)
    return "".join(out)


REPLACE: dict[str, Callable[[bytes, str], str]] = {
    "email": email, "phone": phone, "network": network, "network6": network6, "card": card,
    "social": social, "account": account, "secret": secret, "key": secret, "hex": secret,
    "person": person, "full name": full_name,
}


# --- finding -----------------------------------------------------------------------

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLE = "|".join(t for titles in TITLES.values() for t in titles.split())
_NAME = r"[^\W\d_][\w'’-]*"
_LISTED_NAME = "|".join(n for names in FIRST_NAMES.values() for n in names.split())

# What a text must have at all before a pattern is tried.
_DIGIT = re.compile(r"\d")
_CUE = re.compile(rf"(?<!\w)(?:{_TITLE}|{_LISTED_NAME})(?!\w)")
PATTERNS: list[tuple[str, re.Pattern]] = [
    ("email", re.compile(r"(?<![\w.%+-])[\w.%+-]++@(?:[\w-]++\.)+[^\W\d_]{2,}")),
    ("network", re.compile(rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\w]|\.\d)")),
    (
        "network6",
        re.compile(
            r"(?<![\w:.])(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}"
            r"|(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,5})?::(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,5})?)(?![\w:]|\.\d)"
        ),
    ),
    ("account", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?!\w)")),
    ("card", re.compile(r"(?<![\w.-])[2-6]\d{3}([ -]?)(?:\d{4}\1){2}\d{1,4}(?!\w|[.-]\d)")),
    ("social", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    (
        "phone",
        re.compile(
            r"(?<![\w.+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\w-])"
            r"|(?<![\w.+-])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?![\w-])"
            r"|(?<![\w.+-])0[1-9](?:([ .-])\d{2})(?:\1\d{2}){3}(?![\w-]|[ .-]\d)"
        ),
    ),
    ("hex", re.compile(r"(?<!\w)(?=[a-fA-F]*\d)(?=\d*[a-fA-F])[0-9a-fA-F]{32,}(?!\w)")),
    ("key", re.compile(r"(?<!\w)(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_\w{36}|sk-[\w-]{20,}|xox[abprs]-[\w-]{10,})(?!\w)")),
    ("full name", re.compile(rf"(?<!\w)(?:{'|'.join(n for ns in HAN_NAMES.values() for n in ns.split())})(?!\w)")),
    (
        "secret",
        re.compile(
            r"(?i)(?<![^\W_])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"
            r"\s{0,3}[=:]\s{0,3}[\"']?([^\s\"',;]{6,})"
        ),
    ),
    (
        "person",
        re.compile(
            rf"(?<!\w)(?:(?:{_TITLE})\.? (?!(?:{_TITLE})\b)(?:{_NAME})(?: (?=[^\W\d_a-z]){_NAME})?"
            rf"|(?:{_LISTED_NAME}) {_NAME})(?!\w)"
        ),
    ),
]


def _is_address(text: str) -> bool:
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return True


def find(text: str) -> list[tuple[int, int, str]]:
    """Entities as stretches of the text with their types; none overlap."""
    found = []
    digits = _DIGIT.search(text) is not None
    cue = _CUE.search(text) is not None
    for kind, pattern in PATTERNS:
        if kind == "email" and "@" not in text:
            continue
        if kind in ("network", "account", "card", "social", "phone", "hex") and not digits:
            continue
        if kind == "network6" and "::" not in text and text.count(":") < 7:
            continue
        if kind == "secret" and "=" not in text and ":" not in text:
            continue
        if kind == "person" and not cue:
            continue
        for m in pattern.finditer(text):
            if kind == "secret":
                found.append((*m.span(1), kind))
            elif kind == "account":
                plain = m[0].replace(" ", "")
                if plain[2:4] == _iban_check(plain[:2], plain[4:]):
                    found.append((*m.span(), kind))
            elif kind == "network6":
                # Shorter ones, or without a digit, are more likely names in a program.
                if len(m[0]) > 5 and _DIGIT.search(m[0]) and _is_address(m[0]):
                    found.append((*m.span(), kind))
            elif kind == "person":
                words = m[0].split()
                if all(not w[0].islower() for w in words):
                    found.append((*m.span(), kind))
            else:
                found.append((*m.span(), kind))
    found.sort(key=lambda f: (f[0], -f[1]))
    out: list[tuple[int, int, str]] = []
    for stretch in found:
        if not out or stretch[0] >= out[-1][1]:
            out.append(stretch)
    return out


@lru_cache(100_000)
def surrogate(key: bytes, kind: str, entity: str) -> str:
    return REPLACE[kind](key, entity)


def replaced(key: bytes, text: str) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with surrogates, and (type, entity, surrogate) of every replacement."""
    out, at, log = [], 0, []
    for begin, end, kind in find(text):
        entity = text[begin:end]
        new = surrogate(key, kind, entity)
        out += [text[at:begin], new]
        at = end
        log.append((kind, entity, new))
    return "".join([*out, text[at:]]), log


def replacement(key: str, text: str = "text") -> Column:
    """``struct<text, n_replaced, n_entities, kinds>`` of a text column."""
    ship_package()
    secret_key = key.encode()

    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            if value is None:
                rows.append((None, 0, 0, ""))
                continue
            new, log = replaced(secret_key, value)
            kinds = ",".join(sorted({kind for kind, _, _ in log}))
            rows.append((new, len(log), len({(k, e) for k, e, _ in log}), kinds))
        release_memory()
        return pd.DataFrame(rows, columns=["text", "n_replaced", "n_entities", "kinds"])

    return F.pandas_udf(run, "text string, n_replaced long, n_entities long, kinds string")(
        F.col(text)
    )


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """The documents with surrogates in their texts, and their lengths if they have them as
    ``n_chars``; all other columns as they are."""
    new = "__surrogates"
    changed = docs.withColumn(new, replacement(key)).withColumn("text", F.col(f"{new}.text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.length("text").cast(kind))
    return changed.select(*docs.columns)


def report(docs: DataFrame, key: str) -> DataFrame:
    """``doc_id, text, n_replaced, n_entities, kinds`` of every document."""
    return docs.select("doc_id", replacement(key).alias("new")).select("doc_id", "new.*")
