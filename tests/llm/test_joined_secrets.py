"""Secrets beside allowed words, and secrets without a digit."""

import math
import random
import re
import string
from collections import Counter

import duckdb
from awkward_rows import awkward  # noqa: F401
from cinetally.llm import queries, secret_scan
from test_scans import SECRETS

RANDOM = random.Random(7)
B64, B62, LETTERS = string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits, string.ascii_letters


def token(alphabet, n):
    return "".join(RANDOM.choices(alphabet, k=n))


def dense(text):
    """(start, end) of the entropy spans, window by window."""
    for m in re.finditer(secret_scan.CANDIDATE, text):
        if any(re.search(p, m[0]) for p in secret_scan.ALLOWED[:2]):
            continue
        words = [w.span() for w in re.finditer("(?i)example|placeholder|changeme|x{4,}|0{7,}|1234567", m[0])]
        cuts = [0, *(x for w in words for x in w), len(m[0])]
        for a, b in zip(cuts[::2], cuts[1::2], strict=True):
            piece = m[0][a:b]
            least = next((e for _, ps, e in secret_scan.CLASSES + secret_scan.LETTERS if all(re.search(p, piece) for p in ps)), math.inf)
            at = []
            for k in range(len(piece) - 19):
                counts = Counter(piece[k : k + 20]).values()
                if -sum(c / 20 * math.log2(c / 20) for c in counts) >= least - 1e-9:
                    at.append(k)
            if at:
                yield m.start() + a + at[0], m.start() + a + at[-1] + 20


def test_thorough_scans(spark, awkward, tmp_path):
    secret = token(B62, 40)
    found = [f"users/example/keys/{secret}", f"{secret}_changeme", "XxxX" + secret, f"{secret}0000000000{secret}", "aQwErTyUiOpAsDfGhJkLz",
             token(B64, 3_000) + "xxxx" + token(B64, 3_000), "MFRGGZDFMZTWQ2LKNNWG", "QWERTZUIOPASDFGHJKLY"]
    allowed = ["12345678901234567890123", "550e8400-e29b-41d4-a716-446655440000", "example_example_example", "x" * 500, "00000000-0000-0000-0000-000000000000"]
    bits = ["example", "xxxx", "0000000", "changeme", "/", "=", " ", "aB3dE5fG7hI9jK1lM", "QwErTzUi", "漢", "1234567", secret, "abcdef0123456789"]
    mixed = ["".join(RANDOM.choices(bits, k=12)) for _ in range(300)]
    rows = list(enumerate([*found, *allowed, *mixed, *SECRETS]))
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(awkward)
    got = secret_scan.scan(df).collect()
    plain = secret_scan.scan(df, thorough=False).collect()
    for r, p, d in zip(got, plain, df.collect(), strict=True):
        spans = [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("entropy")]
        assert spans == list(dense(d.text or "")), d.text
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.n_entropy) == (p.n_assign, p.n_access, p.n_hex, p.base_sha256, len(spans))
    assert all(r.n_entropy for r in got[: len(found)])
    assert not any(r.n_entropy for r in got[len(found) : len(found) + len(allowed)])
    df.filter("doc_id is not null").dropDuplicates(["doc_id"]).write.parquet(folder := str(tmp_path / "documents.parquet"))
    duck = duckdb.connect()
    duck.sql(f"create view documents as select * from '{folder}/*.parquet'")
    expected = duck.sql(queries.oracle_sql()["op6_secrets"]).fetchall()
    rows = queries.queries()["op6_secrets"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)


def test_random_tokens_without_a_digit(spark):
    rows = [(i, token(LETTERS if i % 2 else string.ascii_uppercase, 20)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n = Counter(r.doc_id % 2 for r in secret_scan.scan(df).collect() if r.n_entropy)
    assert n[1] >= 190 and n[0] >= 170
