"""Personal data by weak supervision.

Every whole text is searched once for candidate spans: the base kinds (email,
ip, card, phone), which always stay, and looser kinds (secret: long tokens of
letters and digits; number: long digit groups), which the method decides on.
Three labelers vote on each candidate, +1, 0 or -1: its format (regex), fixed
lists of issuers, codes and names (gazetteer) and the text around it (context).
Expectation-maximisation estimates from the vote patterns alone how often each
labeler is right for each kind, and with that the probability of each pattern.
These soft labels train the final classifier, a logistic regression over votes,
length, neighbours and kind; it decides on the loose candidates.

At scale: candidates are found where the texts are and written as a small table
without texts. Patterns and features are codes from a fixed finite set
(``CODES`` values), counted by a shuffle of partial sums; the driver fits both
models on at most that many counts.

Defined results: a null text is empty and has no spans; repeated rows are rows
of their own; an empty table gives an empty result; positions are code points,
ends exclusive; extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

KINDS = ("email", "ip", "card", "phone", "secret", "number")
BASE = 4
ACCEPT = 0.5

# --- fixed values: public lists of the gazetteer and context labelers ---
TOP_DOMAINS = {"com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu"}
CALLING_CODES = ("1", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49",
                 "52", "54", "55", "61", "64", "65", "7", "81", "82", "86", "90", "91")
CARD_ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "60", "62", "65")
SECRET_NAMES = ("token", "secret", "password", "passwd", "apikey", "api_key", "key", "bearer", "auth")
NUMBER_NAMES = ("account", "iban", "ssn", "passport", "card", "phone", "tel", "konto", "compte", "cuenta")
BASE_NAMES = ("mail", "contact", "call", "phone", "tel", "card", "visa", "pay", "server", "address", "host", "from", "ip")
# --- end of fixed values ---

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
NUMBER = re.compile(r"[0-9](?:[ ./()-]?[0-9]){7,}")
TOKEN = re.compile(r"[A-Za-z0-9_+/-]+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
TOKEN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, from each @ outward."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        a = at
        while a > done and text[a - 1] in LOCAL_CHARS:
            a -= 1
        m = DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append((a, m.end()))
            done = m.end()
        # an unmatched @ ends any local part, so a later one never crosses it
        at = text.find("@", m.end() if m else at + 1)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the base kinds."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[-3:] or 0) <= 255 for p in m[0].split(".")):
                out.append((1, *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = _digits(m[0])
                if 16 <= len(d) <= 19 and luhn(d):
                    out.append((2, *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= len(_digits(m[0])) <= 15:
                    out.append((3, *m.span()))
    return out


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates of the loose kinds that overlap no base span and not each other."""
    out = []
    taken = sorted((a, b) for _, a, b in base)

    def free(a: int, b: int) -> bool:
        return all(b <= x or y <= a for x, y in taken)

    done = 0
    for m in DIGIT.finditer(text):
        p = m.start()
        if p < done:
            continue
        a = p
        while a > done and text[a - 1] in TOKEN_CHARS:
            a -= 1
        b = TOKEN.match(text, p).end()
        done = b
        if b - a >= 20 and any(c.isalpha() for c in text[a:b]) and free(a, b):
            out.append((4, a, b))
            taken.append((a, b))
    taken.sort()
    at = 0
    for a, b in [*taken, (len(text), len(text))]:
        # the end of a gap ends a number too, so none reaches into a span
        out += [(5, *m.span()) for m in NUMBER.finditer(text, at, max(at, a))]
        at = max(at, b)
    return out


def _format_vote(kind: int, s: str) -> int:
    if kind == 0:
        tail = s.rsplit(".", 1)[1]
        return 1 if tail.isalpha() and len(tail) >= 2 and s[0] not in ".-+%" else -1
    if kind == 1:
        return 1 if all(p == "0" or p[0] != "0" for p in s.split(".")) else -1
    if kind == 2:
        return 1 if s.isdigit() or re.fullmatch(r"[0-9]{4}(?:([ -])[0-9]{4})(?:\1[0-9]{4})+", s) else 0
    if kind == 3:
        return 1 if re.fullmatch(r"\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{1,5}\)?)+", s) else 0
    if kind == 4:
        return 1 if re.fullmatch(r"[0-9a-f]{32,}|[0-9A-F]{32,}", s) else 0 if len(set(s)) > 8 else -1
    d = _digits(s)
    return 1 if len(d) in (9, 16) else 0 if len(d) <= 19 else -1


def _list_vote(kind: int, s: str, before: str) -> int:
    if kind == 0:
        return 1 if s.rsplit(".", 1)[1].lower() in TOP_DOMAINS else 0
    if kind == 1:
        return -1 if s.split(".")[0] in ("0", "127", "255") else 1
    if kind == 2:
        return 1 if _digits(s).startswith(CARD_ISSUERS) else -1
    if kind == 3:
        return 1 if _digits(s).startswith(CALLING_CODES) else -1
    names = SECRET_NAMES if kind == 4 else NUMBER_NAMES
    last = re.findall(r"[a-z_]+", before)[-1:]
    return 1 if last and last[0] in names else 0


def _context_vote(kind: int, text: str, a: int, b: int, before: str) -> int:
    left, right = text[a - 1 : a], text[b : b + 1]
    if left.isalnum() or right.isalnum():
        return -1
    if kind == 4:
        return 1 if left in "\"'=:" and left else 0
    names = NUMBER_NAMES if kind == 5 else BASE_NAMES
    return 1 if any(n in before for n in names) else 0


def _edge(c: str) -> int:
    return 0 if not c or c.isspace() else 1 if c.isalnum() else 2 if c in "\"'=:([<" else 3


#: kind, three votes, length class, character before, character after
SHAPE = (len(KINDS), 3, 3, 3, 5, 4, 4)
CODES = int(np.prod(SHAPE))


def code_of(kind: int, text: str, a: int, b: int) -> int:
    """One number for a candidate's votes and features, below ``CODES``."""
    s, before = text[a:b], text[max(0, a - 40) : a].lower()
    votes = (_format_vote(kind, s), _list_vote(kind, s, before), _context_vote(kind, text, a, b, before))
    size = min(4, (b - a) // 10)
    return int(np.ravel_multi_index((kind, *(v + 1 for v in votes), size, _edge(text[a - 1 : a]) if a else 0,
                                     _edge(text[b : b + 1])), SHAPE))


# --- models over counts of codes -------------------------------------------------

def reliabilities(codes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Probability of each code being personal data: per kind a two-class model
    whose labelers vote independently given the class, by EM from a start that
    trusts every labeler a little."""
    parts = np.array(np.unravel_index(codes, SHAPE))
    kind, votes = parts[0], parts[1:4]
    out = np.zeros(len(codes))
    for k in range(len(KINDS)):
        at = np.flatnonzero(kind == k)
        if not len(at):
            continue
        n, v = counts[at].astype(float), votes[:, at]
        p = 1 / (1 + np.exp(-1.5 * (v - 1).sum(axis=0)))
        for _ in range(rounds):
            prior = ((n * p).sum() + 1) / (n.sum() + 2)
            good, bad = np.full(len(at), np.log(prior)), np.full(len(at), np.log(1 - prior))
            for lab in range(3):
                # a labeler is taken to be right more often than wrong: pseudo-counts lean that way
                yes = np.bincount(v[lab], n * p, 3) + (0.5, 1, 2)
                no = np.bincount(v[lab], n * (1 - p), 3) + (2, 1, 0.5)
                good += np.log(yes / yes.sum())[v[lab]]
                bad += np.log(no / no.sum())[v[lab]]
            p = 1 / (1 + np.exp(np.clip(bad - good, -50, 50)))
        out[at] = p
    return out


def classifier(codes: np.ndarray, counts: np.ndarray, soft: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Probability of each code from a logistic regression over its parts,
    fitted to soft labels with weights (damped diagonal steps)."""
    if not len(codes):
        return np.zeros(0)
    parts = np.array(np.unravel_index(codes, SHAPE))
    kind = parts[0]
    columns = [np.eye(len(KINDS))[kind]] + [np.eye(size)[p] for size, p in zip(SHAPE[1:], parts[1:])]
    columns += [np.eye(len(KINDS) * 3)[kind * 3 + v] for v in parts[1:4]]
    x = np.concatenate(columns, axis=1)
    w, n = np.zeros(x.shape[1]), counts / counts.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (n * (soft - p)) - 1e-4 * w
        h = (x * x).T @ (n * np.maximum(p * (1 - p), 0.05)) + 1e-4
        w += 0.3 * g / h
    return 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,p:double>>"
RAW = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("code", pa.int32())]))


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """One row per row of ``docs``: its id and ``spans`` (kind, start, end,
    whether a base span, probability), by kind as listed, then start."""

    def candidates(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts:
            text = t.as_py() or ""
            base = base_spans(text)
            every = sorted(base + (loose_spans(text, base) if base or DIGIT.search(text) else []))
            out.append([{"kind": k, "start": a, "end": b, "code": code_of(k, text, a, b)} for k, a, b in every])
        return pa.array(out, RAW)

    raw = F.arrow_udf(candidates, "array<struct<kind:int,start:int,end:int,code:int>>")
    found = cut(docs.select(F.col(id_col), raw(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("raw")), "pii")
    seen = found.select(F.explode("raw.code").alias("code")).groupBy("code").count().collect()  # at most CODES rows
    codes, counts = np.array([r[0] for r in seen], np.int64), np.array([r[1] for r in seen], np.int64)
    table = np.zeros(CODES)
    table[codes] = classifier(codes, counts, reliabilities(codes, counts))

    def decide(raws: pa.Array) -> pa.Array:
        return pa.array([[{"kind": KINDS[x["kind"]], "start": x["start"], "end": x["end"], "base": x["kind"] < BASE,
                           "p": float(table[x["code"]])} for x in row or () if x["kind"] < BASE or table[x["code"]] >= accept]
                         for row in raws.to_pylist()],
                        pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                            ("base", pa.bool_()), ("p", pa.float64())])))

    return found.select(id_col, F.arrow_udf(decide, SPANS)("raw").alias("spans"))
