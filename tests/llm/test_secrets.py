from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import string

import duckdb
from pyspark.sql import functions as F

from ledgerloom.llm import secrets
from ledgerloom.llm.queries import QUERIES
from llm_rows import SMALL, docs_of

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def plain_base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def spelled(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def base_of(r):
    return [(s.start, s.rank, s.end) for s in r.base]


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in QUERIES["op2_secret_randomness"](spark, SMALL).collect()}
    assert set(got) == {i for i, _ in rows}
    for i, text in rows:
        want = plain_base(text)
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == j for _, k, _ in want) for j in range(3)]
        assert got[i].base_sha256 == hashlib.sha256(spelled(want).encode()).hexdigest()
        assert set(spelled(want).split(",")) <= set(got[i].spans.split(","))


def test_base_spans_of_odd_texts(spark):
    odd = [
        None, "", "token=abcdefgh", "TOKEN: 'short' token=secret: abcdefgh1", "password=secret=abcdefgh1",
        "ſecret=abcdefgh12 toKen=abcdefgh12", "😀é api_key = \"x1234567\" 😀 APIKEY:abcdefghi", "AKIA" + "A1" * 6 + "AKIA", "AKIAKIA123456789012",
        "f" * 31 + " " + "0f" * 16 + "g" + "ab" * 40, "secret=" + "0a" * 20, "x" * 10 + "passwd   =    12345678",
        "".join(f"token=abcdefgh{i} é " for i in range(3000)), "secret" * 5000, "token= abcdefgh",
    ]
    docs = docs_of(spark, [*enumerate(odd), (None, odd[2]), (2, odd[2])])
    rows = secrets.secrets(docs).collect()
    assert len(rows) == len(odd) + 2
    for r in rows:
        assert base_of(r) == plain_base(odd[2] if r.doc_id is None else odd[r.doc_id]), r.doc_id
    assert secrets.secrets(docs.where(F.lit(False))).count() == 0


def plain_battery(value):
    c = value.rstrip("=").translate(str.maketrans("-_", "+/"))
    alphabet, share = next((a, s) for p, a, s in secrets.ENCODINGS if re.search(p, c) or not p)
    if len(alphabet) <= 36:
        c = c.lower()
    n, k, v = len(c), len(alphabet), [alphabet.index(x) for x in c]
    squares = sum(v.count(x) ** 2 for x in set(v))
    chi2 = k * squares / n - n
    chi = ((chi2 / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    bits = [x >= k // 2 for x in v]
    high, runs = sum(bits), 1 + sum(a != b for a, b in zip(bits, bits[1:]))
    mu = 1 + 2 * high * (n - high) / n
    z_runs = (runs - mu) / math.sqrt((mu - 1) * (mu - 2) / (n - 1))
    m = sum(v) / n
    d = [x - m for x in v]
    serial = (sum(a * b for a, b in zip(d, d[1:])) / sum(x * x for x in d) + 1 / n) * math.sqrt(n)
    return {"chi": chi, "runs": z_runs, "serial": serial}


def test_battery_tells_keys_from_words(spark):
    rng = random.Random(5)
    keys = [rng.randbytes(24).hex()[:30] for _ in range(20)]
    keys += [base64.urlsafe_b64encode(rng.randbytes(33)).decode() for _ in range(30)]
    keys = [k for k in keys if re.fullmatch(secrets.RUN.replace("(?<![A-Za-z0-9+/_-])", "").replace("*+", "*").replace("}+=", "}="), k)]
    names = [f"get_customer_address_by_region_v{i}_and_the_rest_of_the_order" for i in range(50)]
    names += ["aaaaaaaaaaaaaaaaaaaaaaaa1111111111111111", "0123456789" * 4, "00000000000000000000000000", "abababababababababababab12"]
    docs = docs_of(spark, [(i, f"see {t} here") for i, t in enumerate(keys + names)])
    found = {r.doc_id: r for r in secrets.scan(docs).collect()}
    for i, t in enumerate(keys[:10] + keys[-10:]):
        i = i if i < 10 else len(keys) - 20 + i
        for name, value in plain_battery(keys[i]).items():
            assert abs(found[i].runs[0].test[name] - value) < 1e-6, (name, keys[i])
    added = {r.doc_id: [(s.start, s.end) for s in r.added] for r in secrets.secrets(docs).collect()}
    hits = [i for i, s in added.items() if s]
    assert all(i < len(keys) for i in hits) and len(hits) > 0.7 * len(keys)
    assert all(added[i] == [(4, 4 + len(keys[i]))] for i in hits)


def test_redaction(spark):
    texts = ["a token=abcdefgh12 b", "é AKIA" + "A1" * 8 + "é", "secret=" + "0a" * 20 + " end", None, "", "plain", "token=abcdefgh12"]
    docs = docs_of(spark, [*enumerate(texts), (0, texts[0])])
    out = secrets.redact(docs)
    assert out.columns == docs.columns
    got = sorted((r.doc_id, r.text or "") for r in out.collect())
    want = ["a [secret] b", "é [secret]é", "[secret] end", "", "", "plain", "[secret]"]
    assert got == sorted([*enumerate(want), (0, want[0])])
    assert out.where("doc_id = 3").first().text is None


def test_letter_only_keys_and_keys_around_a_known_form_are_found(spark):
    """Random letters without a digit, and a long key that holds an access key: over half pass the battery."""
    rng = random.Random(1)
    letters = ["".join(rng.choices(string.ascii_letters, k=40)) for _ in range(60)]
    around = ["".join(rng.choices(string.ascii_letters + string.digits, k=20)) + "AKIA" + "".join(rng.choices(string.ascii_uppercase + string.digits, k=16)) for _ in range(60)]
    plain = ["an ordinary sentence about internationalisation and well-known-long-names of /usr/share/documentation"] * 60
    texts = [f"the key {k} ends here" for k in letters + around] + plain
    found = {r.doc_id: r for r in secrets.secrets(docs_of(spark, list(enumerate(texts)))).collect()}
    held = lambda i: [(s["start"], s["end"]) for s in found[i].added]
    whole = [held(i) == [(8, 8 + len(k))] for i, k in enumerate(letters + around)]
    assert sum(whole[:60]) > 40 and sum(whole[60:]) > 30
    assert all(len(found[60 + i].base) == 1 for i in range(60)) and not any(held(i) for i in range(120, 180))
    kept = secrets.redact(docs_of(spark, list(enumerate(texts)))).collect()
    assert all("AKIA" not in r.text for r in kept)
