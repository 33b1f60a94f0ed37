import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerwatch.llm import pii, secret_scan

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, s):
    n = sum(c.isdigit() for c in s)
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in s.split(".")), "card": kind == "card" and 13 <= n <= 19 and pii.luhn(re.sub("[ -]", "", s)), "phone": 9 <= n <= 15}[kind]


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if good(k, m[0])]


AUTOMATON = pii.anchors()
PARTS = st.sampled_from(["1", "12", "255", "256", "4111111111111111", "4111 1111 1111 1111", "-", " ", ".", "@", "a", "b.c", "+", "+1 (017) 555-7713", "(", ")", "x@y.z", "é", "://", "\n", "0"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join))
def test_base_kinds_equal_the_patterns(text):
    got = pii.find(text, AUTOMATON)
    assert [(k, a, b) for k in pii.BASE_KINDS for a, b in got[k]] == brute(text)


def test_added_kinds():
    got = pii.find("See https://example.org/a?b, IBAN GB82 WEST 1234 5698 7654 32. Account number: 12345678; at 12 Long Mill Road", AUTOMATON)
    assert len(got["url"]) == len(got["iban"]) == len(got["account"]) == len(got["address"]) == 1


def test_pii_rows(spark):
    docs = spark.createDataFrame([(1, "a@b.co " * 3, 1), (1, "a@b.co " * 3, 1), (None, None, 2), (3, "", None), (4, "x" * 200_000 + "@b.c", 5)], "doc_id long, text string, n_email int")
    rows = pii.personal_data(docs).collect()
    assert sorted((r.doc_id or 0, r.n_email) for r in rows) == [(0, 0), (1, 3), (1, 3), (3, 0), (4, 1)]
    assert {r.base_sha256 for r in rows if not r.n_email} == {hashlib.sha256(b"").hexdigest()}
    assert pii.personal_data(docs.limit(0)).count() == 0


KEY = r"(?:password|passwd|secret|token|api_?key)"


def brute_secrets(text):
    out = [("assign", m.start(), m.end()) for m in re.finditer(rf"""(?ai:({KEY}))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda x: (x[1], secret_scan.KINDS.index(x[0])))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "Api_Key", "SECRET", "=", ":", " ", '"', "'", "abcdefgh", "abc", "AKIA", "ABCDEFGH1234", "deadbeef" * 4, "g", "é", "\n", "ſecret"]), max_size=14).map("".join))
def test_base_secrets_equal_the_patterns(text):
    encoding = secret_scan.vocabulary()
    assert [x for x in secret_scan.find(text, encoding, 2.0) if x[0] != "token"] == brute_secrets(text)


def test_token_efficiency():
    encoding = secret_scan.vocabulary()
    kinds = lambda t: [k for k, _, _ in secret_scan.find(t, encoding, 2.0)]
    assert kinds("xQ7pL0zV9kR2mT4wB8nJ") == ["token"]
    assert not kinds("internationalization_of_2_words_and_names")
    assert not kinds("123e4567-e89b-12d3-a456-426614174000 " + "D41D8CD98F00B204E9800998ECF8427E")


def test_the_ratio_decides_runs_of_one_case():
    """Random letters of one case are found, words and names of any length are not."""
    encoding, rng = secret_scan.vocabulary(), random.Random(1)
    found = lambda text: any(k == "token" for k, _, _ in secret_scan.find(text, encoding, 2.0))
    for letters in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz-", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"):
        for n in (20, 32, 40):
            assert sum(found("".join(rng.choice(letters) for _ in range(n))) for _ in range(300)) >= 255, (letters, n)
    names = ["spark_sql_shuffle_partitions", "Donaudampfschifffahrtsgesellschaft", "src/main/java/org/example/service", "internationalization-localization", "MAXIMUM_NUMBER_OF_CONNECTIONS", "getElementsByClassNameAndIndex", "anticonstitutionnellement", "chpfheitschverheiten", "queelleaiierelletion", "a" * 40, "=" * 40, "2024-01-02-03-04-05-06"]
    assert not [n for n in names if found(n)]


def test_odd_hexadecimal_and_letters_alone_are_tokens():
    encoding = secret_scan.vocabulary()
    kinds = lambda t: [k for k, _, _ in secret_scan.find(t, encoding, 2.0)]
    digits = hashlib.sha512(b"ledger").hexdigest()
    for n in (20, 24, 31, 36, 48):
        assert "token" in kinds(digits[:n]) and kinds(digits[:n].upper()) == ["token"], n
    assert not any("token" in kinds(digits[:n]) for n in (32, 40, 56, 64, 96, 128))
    assert kinds("xQvpLhzVikRgmTfwBbnJ") == ["token"]
    for name in ("getElementsByClassNameAndTagName", "MAX_CONNECTION_RETRIES_PER_HOST", "przedsiebiorczosciowego", "a/b/c/d/e/f/g/h/i/j/k/l", "=" * 30, "2024-01-01_2024-12-31_00"):
        assert not kinds(name), name


def test_secret_rows_and_redaction(spark):
    docs = spark.createDataFrame([(1, 'token = "abcdefgh1" end', 23), (2, None, 0), (3, "", 0), (1, 'token = "abcdefgh1" end', 23)], "doc_id long, text string, n_chars long")
    assert sorted((r.doc_id, r.n_assign) for r in secret_scan.secrets(docs).collect()) == [(1, 1), (1, 1), (2, 0), (3, 0)]
    rows = sorted(secret_scan.redacted(docs).collect(), key=lambda r: r.doc_id)
    assert rows[0].text == '[SECRET]" end' and rows[0].n_chars == 13 and rows[2].text is None
    assert secret_scan.redacted(docs.limit(0)).columns == docs.columns


def test_secrets_of_a_very_long_text_and_a_column_of_the_same_name(spark):
    long = "lorem ipsum " * 200_000 + 'token = "abcdefgh1"'
    docs = spark.createDataFrame([(1, long, "x"), (None, "AKIA" + "B" * 16, "y")], "doc_id long, text string, n_hex string")
    rows = {r.doc_id: r for r in secret_scan.secrets(docs).collect()}
    assert rows[1].n_assign == 1 and rows[1].spans.startswith("assign:2400000:") and rows[None].n_access == 1
    out = {r.doc_id: r for r in secret_scan.redacted(docs).collect()}
    assert out[1].text.endswith('[SECRET]"') and out[1].n_hex == "x" and out[None].text == "[SECRET]"
