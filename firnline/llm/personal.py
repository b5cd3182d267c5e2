"""Personal data by anchor expansion: an automaton finds cues, small parsers grow and check the spans.

The automaton holds at-signs, plus signs before a digit, dots before a digit, two digits in a row (also with a
blank or hyphen between), schemes and the names of identifiers. From each anchor a parser walks left and right over the
characters its kind allows. The base kinds give exactly the leftmost non-overlapping matches of

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, parts at most 255
* card ``[0-9]([\\x20-]?[0-9])+``, 16 to 19 digits that pass Luhn
* phone ``\\+[0-9][\\x20().0-9-]+[0-9]``, 8 to 15 digits

with failing matches dropped. Beyond them: ``url`` (a scheme and the address after it) and ``account``, the value after
a cue, expanded and checked by a parser of the cue's own:

* IBAN: groups of letters and digits with single blanks or hyphens between, 15 to 34 in all, check digits by mod 97
* account number: 6 to 20 digits in groups, not all zero; SSN: 3-2-4 digits in the shape of a number that can be issued
* passport: 6 to 9 letters and digits, one digit at least
* password, token, key, secret: six characters or more after ``:`` or ``=``; without those, a digit must be among them
* keys that show what they are by their first letters (``AKIA…``, ``ghp_…``) need no cue

Offsets are code points, ends exclusive.

Cases: null is the empty text, without spans; a text may be of any length, each anchor is expanded once; repeated
rows give repeated results; extra columns ride along.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from firnline.llm.common import per_batch, text_of

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")
SPANS = "array<struct<kind:string,start:int,end:int>>"

# Schemes and the names that announce an identifier.
SCHEMES = ("http://", "https://", "ftp://", "mailto:", "tel:")
CUES = ("password", "passwd", "pwd", "token", "api_key", "apikey", "secret", "iban", "account", "ssn", "passport")
KEYS = {"akia": 16, "asia": 16, "ghp_": 36, "gho_": 36, "sk_live_": 24}  # first letters, and how many follow

DIGITS = "0123456789"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
DIGIT = frozenset(DIGITS)
PHONE = frozenset(" ().0123456789-")
LETTER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")
ADDRESS = re.compile(r"[^\s<>\"']+")
LINK = r"(?:[\s:=#]{1,4}|(?=[:=#]))(?:(?:number|no\.?|nr\.?)[\s:=#]{1,3})?[\"']?"
SECRET = re.compile(r"(?:(?P<sure>\s{0,2}[:=]\s{0,2}[\"']?)(?P<any>[^\s\"'<>]{6,})|[\s#]{1,4}[\"']?(?P<plain>[A-Za-z0-9][A-Za-z0-9+/_-]{5,}))")
GROUPS = re.compile(LINK + r"((?:[a-z]{2}[0-9]{2})(?:[ -]?[a-z0-9])+)")
NUMBERS = re.compile(LINK + r"([0-9](?:[ -]?[0-9])+)")
PASSPORT = re.compile(LINK + r"([a-z0-9]{6,9})(?![a-z0-9])")


def anchors() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    made.add_word("@", ("email", 1))
    for d in DIGITS:
        made.add_word(f"+{d}", ("phone", 2))
        made.add_word(f".{d}", ("ip", 2))
        for e in DIGITS:
            for gap in ("", " ", "-"):
                made.add_word(f"{d}{gap}{e}", ("card", 2 + len(gap)))
    for s in SCHEMES:
        made.add_word(s, ("url", len(s)))
    for c in (*CUES, *KEYS):
        made.add_word(c, ("account", len(c)))
    made.make_automaton()
    return made


def run_right(t: str, i: int, allowed: frozenset) -> int:
    n = len(t)
    while i < n and t[i] in allowed:
        i += 1
    return i


def run_left(t: str, i: int, floor: int, allowed: frozenset) -> int:
    while i > floor and t[i - 1] in allowed:
        i -= 1
    return i


def email_at(t: str, at: int, floor: int) -> tuple[int, int] | None:
    start = run_left(t, at, floor, LOCAL)
    end = run_right(t, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(t) and t[end] == "." and (further := run_right(t, end + 1, LABEL)) > end + 1:
        end, labels = further, labels + 1
    return (start, end) if labels else None


def digit_chain(t: str, i: int, floor: int, gaps: str) -> tuple[int, list[tuple[int, int]]]:
    """The whole chain of digit runs with one of ``gaps`` between them that holds position ``i``: its runs."""
    start = run_left(t, i, floor, DIGIT)
    while start - 2 >= floor and t[start - 1] in gaps and t[start - 2] in DIGIT:
        start = run_left(t, start - 1, floor, DIGIT)
    runs = []
    while True:
        end = run_right(t, start, DIGIT)
        runs.append((start, end))
        if end + 1 < len(t) and t[end] in gaps and t[end + 1] in DIGIT:
            start = end + 1
        else:
            return end, runs


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def phone_at(t: str, at: int) -> tuple[int, int] | None:
    end = run_right(t, at + 2, PHONE)
    while end > at + 3 and t[end - 1] not in DIGIT:
        end -= 1
    return (at, end) if end > at + 3 else None


def iban_end(t: str, start: int, end: int) -> int | None:
    """Where the longest IBAN that begins at ``start`` ends, on an edge of its groups."""
    best, code = None, ""
    for i in range(start, min(end, start + 68)):
        if t[i] in " -":
            continue
        code += t[i]
        edge = i + 1 == end or t[i + 1] not in LETTER
        if edge and 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            best = i + 1
    return best


def issued(digits: str) -> bool:
    """Whether a social security number can have been issued."""
    return (len(digits) == 9 and digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00"
            and digits[5:] != "0000")


def account_at(t: str, cue: str, at: int) -> tuple[int, int] | None:
    """The checked value after a cue that ends at ``at``."""
    if cue == "iban":
        m = GROUPS.match(t, at)
        end = m and iban_end(t, m.start(1), m.end(1))
        return (m.start(1), end) if end else None
    if cue in ("account", "ssn"):
        m = NUMBERS.match(t, at)
        if not m or m.end() < len(t) and t[m.end()] in LETTER:
            return None
        digits = "".join(c for c in m[1] if c in DIGIT)
        if cue == "ssn":
            shape = [len(p) for p in re.split("[ -]", m[1])]
            return m.span(1) if shape in ([9], [3, 2, 4]) and issued(digits) else None
        return m.span(1) if 6 <= len(digits) <= 20 and digits.strip("0") else None
    if cue == "passport":
        m = PASSPORT.match(t, at)
        return m.span(1) if m and any(c in DIGIT for c in m[1]) else None
    m = SECRET.match(t, at)
    if not m:
        return None
    if m["plain"]:
        return m.span("plain") if any(c in DIGIT for c in m["plain"]) else None
    end = m.end("any")
    while end > m.start("any") and t[end - 1] in ".,;)]}":
        end -= 1
    return (m.start("any"), end) if end >= m.start("any") + 6 else None


def key_at(t: str, at: int, size: int, follow: int) -> tuple[int, int] | None:
    """A key of ``follow`` letters and digits after its first letters, with nothing of the kind around it."""
    end = at + size + follow
    body = t[at + size: end]
    if at and t[at - 1] in LETTER or end < len(t) and t[end] in LETTER or len(body) < follow:
        return None
    return (at, end) if body.isascii() and body.isalnum() and any(c in DIGIT for c in body) else None


def find(text: str, automaton: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every span, by kind as listed, then start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    done = dict.fromkeys(KINDS, 0)  # where the last match of the kind ended
    for last, (kind, size) in automaton.iter(text):
        at = last + 1 - size
        if kind == "email":
            if at >= done[kind] and (span := email_at(text, at, done[kind])):
                found[kind].append(span)
                done[kind] = span[1]
        elif kind == "ip":
            if last >= done[kind] and at and text[at - 1] in DIGIT:
                done[kind], runs = digit_chain(text, last, done[kind], ".")
                for k in range(0, len(runs) - 3, 4):
                    four = runs[k: k + 4]
                    if all(at_most_255(text[a:b]) for a, b in four):
                        found[kind].append((four[0][0], four[3][1]))
        elif kind == "card":
            if at >= done[kind]:
                done[kind], runs = digit_chain(text, at, done[kind], " -")
                if 16 <= sum(b - a for a, b in runs) <= 19 and luhn("".join(text[a:b] for a, b in runs)):
                    found[kind].append((runs[0][0], runs[-1][1]))
        elif kind == "phone":
            if at >= done[kind] and (span := phone_at(text, at)):
                done[kind] = span[1]
                if 8 <= sum(c in DIGIT for c in text[slice(*span)]) <= 15:
                    found[kind].append(span)
        elif kind == "url":
            if at >= done[kind] and (at == 0 or text[at - 1] not in LETTER) and (m := ADDRESS.match(text, last + 1)):
                end = m.end()
                while end > m.start() and text[end - 1] in ".,;:!?)]}":
                    end -= 1
                if end > m.start():
                    found[kind].append((at, end))
                    done[kind] = end
        elif at >= done[kind] and (at == 0 or text[at - 1] not in LETTER):
            word = text[at: last + 1]
            span = key_at(text, at, size, KEYS[word]) if word in KEYS else account_at(text, word, last + 1)
            if span:
                found[kind].append(span)
                done[kind] = span[1]
    return [(k, a, b) for k in KINDS for a, b in sorted(found[k])]


def lowered(text: str) -> str:
    """A-Z in lower case, so that cues are found in any case; lengths stay."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def personal_spans(text: str | Column = "text") -> Column:
    """Column: the spans of personal data in a text."""
    def make():
        automaton = anchors()
        kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

        def act(texts: pa.Array) -> pa.Array:
            return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in find(lowered(t), automaton)]
                             for t in texts.to_pylist()], kinds)

        return act

    return per_batch(make, SPANS)(text_of(text))


def masked(spans: str = "spans", text: str = "text") -> Column:
    """Column: the text with every span replaced by its kind in brackets (overlapping spans by the first)."""
    def make():
        def act(rows: pa.Array) -> pa.Array:
            out = []
            for r in rows.to_pylist():
                t, at, parts = r["text"], 0, []
                for s in sorted(r["spans"], key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= at:
                        parts += [t[at: s["start"]], f"[{s['kind']}]"]
                        at = s["end"]
                out.append("".join([*parts, t[at:]]))
            return pa.array(out, pa.string())

        return act

    return per_batch(make, "string")(F.struct(text_of(text).alias("text"), F.col(spans).alias("spans")))
