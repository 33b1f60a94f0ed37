"""Personal data by anchor expansion.

An Aho-Corasick automaton runs once over the text and stops at anchors: at-signs, schemes, plus signs, digits and
identifier cues. From each anchor a local parser walks outwards to the boundaries of an email, an IP or street address, a
card, phone or account number, and validates it. No pattern is searched for where there is no anchor.

Base kinds are leftmost and non-overlapping per kind; a match that fails validation is dropped and not retried:
email, ip (parts up to 255), card (13 to 19 digits, Luhn), phone (9 to 15 digits).
Added kinds: url (a scheme and what follows), iban (mod 97), account (a cue and 6 to 20 digits), address (number and street).
A null or empty text has no spans. Rows are independent: repeated rows give repeated results, a null id stays null.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import documents, id_and_text

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("url", "iban", "account", "address")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
URL_REST = re.compile(r"[^\s<>\"'`]+")
IBAN = re.compile(r"[\s:#]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{1,4}){3,8})(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"(?:\x20(?:number|no\.?|nr\.?))?[\s:#]{1,4}([0-9](?:[\x20-]?[0-9]){5,19})(?![0-9])")
STREET = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,5}[A-Za-z]?\x20(?:[A-Z][A-Za-z'-]{0,30}\x20){1,4}$")

#: Cues of the added kinds, each with the capitals that texts use.
CUES = {"iban": ("IBAN", "iban", "Iban"), "account": ("account", "Account", "acct", "Acct", "Konto", "konto", "compte", "Compte", "cuenta", "Cuenta"), "address": ("Street", "Avenue", "Road", "Boulevard", "Lane")}


def anchors() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for digit in "0123456789":
        a.add_word(digit, ("digit", 1))
    for word, kind in (("@", "email"), ("+", "phone"), ("://", "url")):
        a.add_word(word, (kind, len(word)))
    for kind, words in CUES.items():
        for word in words:
            a.add_word(word, (kind, len(word)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(x), 10)) for x in even)) % 10 == 0


def iban_ok(code: str) -> bool:
    code = code.replace(" ", "")
    return 15 <= len(code) <= 34 and int("".join(str(int(x, 36)) for x in code[4:] + code[:4])) % 97 == 1


def find(text: str, automaton: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """The spans of each kind, in code points, end exclusive."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE_KINDS + ADDED_KINDS}
    past = dict.fromkeys(out, 0)
    digit = -2

    def keep(kind: str, start: int, end: int, ok: bool = True) -> None:
        past[kind] = end
        if ok:
            out[kind].append((start, end))

    for last, (what, size) in automaton.iter(text):
        at, after = last - size + 1, last + 1
        if what == "digit":
            fresh, digit = digit != at - 1, at
            if fresh and at >= past["ip"] and (m := DOTTED.match(text, at)):
                keep("ip", at, m.end(), all(len(x.lstrip("0")) < 4 and int(x[-9:]) <= 255 for x in m[0].split(".")))
            if at >= past["card"]:
                if m := DIGITS.match(text, at):
                    only = m[0].replace(" ", "").replace("-", "")
                    keep("card", at, m.end(), 13 <= len(only) <= 19 and luhn(only))
        elif what == "email":
            start = at
            while start > past["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, after)):
                keep("email", start, m.end())
        elif what == "phone":
            if at >= past["phone"] and (m := PHONE.match(text, at)):
                keep("phone", at, m.end(), 9 <= sum(map(str.isdigit, m[0])) <= 15)
        elif what == "url":
            start = at
            while start > past["url"] and at - start < 20 and text[start - 1] in SCHEME:
                start -= 1
            if start < at and (m := URL_REST.match(text, after)):
                keep("url", start, m.end())
        elif what == "iban":
            if at >= past["iban"] and (m := IBAN.match(text, after)) and iban_ok(m[1]):
                keep("iban", m.start(1), m.end(1))
        elif what == "account":
            if at >= past["account"] and (m := ACCOUNT.match(text, after)):
                keep("account", m.start(1), m.end(1))
        elif at >= past["address"] and (m := STREET.search(text[max(0, at - 150) : at])):
            keep("address", max(0, at - 150) + m.start(), after)
    return out


def joined(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = anchors()
    for batch in batches:
        counts, every = {k: [] for k in BASE_KINDS}, []
        digests = []
        for text in batch.column(1).to_pylist():
            spans = find(text, automaton)
            for k in BASE_KINDS:
                counts[k].append(len(spans[k]))
            base = joined(spans, BASE_KINDS)
            digests.append(hashlib.sha256(base.encode()).hexdigest())
            more = joined(spans, ADDED_KINDS)
            every.append(",".join(x for x in (base, more) if x))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(counts[k], pa.int64()) for k in BASE_KINDS), pa.array(digests, pa.string()), pa.array(every, pa.string())], ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: counts of the base kinds, their digest, and all spans as kind:start:end."""
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return id_and_text(docs, id_col, text_col).mapInArrow(scan, schema)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))
