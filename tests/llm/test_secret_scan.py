"""Secret scans: base spans against another engine on random texts, odd lexing, time that grows with the text."""

import hashlib
import random
import time

import pytest
import regex
from pyspark.sql import functions as F

from salesmart.llm import queries, secret_scan

ASSIGN = regex.compile(
    r"((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
    r"|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS, HEX = regex.compile(r"AKIA[A-Z0-9]+"), regex.compile(r"[0-9a-f]+")
HIDDEN = "q7Xz91Lm0PvR3tYb"


def brute_base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 32]
    return sorted(found)


def digest(found):
    return hashlib.sha256(",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in found).encode()).hexdigest()


def test_base_spans_equal_another_engine():
    rng = random.Random(11)
    bits = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "ſecret", '"', "'", " ", "  ", ":", "=", "abcdefgh", "hunter2", "+/_.=-",
            "AKIA", "ABCDEFGHIJ0123", "ab12" * 9, "é", "K", "\n", "\t", "AKIAAKIA", "0" * 31]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        got = [(x["start"], secret_scan.KINDS.index(x["kind"]), x["end"]) for x in secret_scan.scan_text(text)]
        assert [x for x in got if x[1] < 3] == brute_base(text), text


def test_query_columns(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op5_secrets(spark, sf).collect():
        base = brute_base(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, k, _ in base) for x in range(3))
        assert r.base_sha256 == digest(base)


def spans(text):
    return [text[a:b] for a, b, _, _ in secret_scan.literals(text)]


@pytest.mark.parametrize(
    "text, want",
    [
        (f'db:\n  password:\n    "{HIDDEN}"\n  next: 1\n', [HIDDEN]),  # the value on the next line
        (f"secret:\n  {HIDDEN}", [HIDDEN]),
        (f"secret:\n{HIDDEN}", []),  # not indented: not its value
        (f"secret:\n  name: {HIDDEN}\n", []),  # a key of its own
        (f'a = "{HIDDEN}"\nb = a\nsecret_key = b', [HIDDEN]),
        (f'token = "{HIDDEN}"\n' + "token = token + token\n" * 40, [HIDDEN]),
        (f'p = "{HIDDEN[:8]}"\npassword = "${{p}}{HIDDEN[8:]}"', [HIDDEN[:8], "${p}" + HIDDEN[8:]]),
        (f"password = '{HIDDEN}", []),  # an open quote is no string; the base pattern has it
        (f'password = "a\\"b{HIDDEN}"', [f'a\\"b{HIDDEN}']),
        ('password = "changeme123"', []),
    ],
)
def test_lexing(text, want):
    assert spans(text) == want


@pytest.mark.parametrize(
    "piece, most",
    [
        ("key: b\n", 150_000), ('\\"', 150_000), ("token = token + token\n", 4_000), ('token = "${token}${token}"\n', 4_000),
        ("'", 200_000), ("secret = 'a'; ", 20_000), ("secret:\n", 60_000),
    ],
)
def test_time_grows_with_the_text(piece, most):
    """Twice the text takes about twice the time: far from the four times of a quadratic scan."""
    took = []
    for n in (most // 4, most):
        text = f'secret = "{HIDDEN}"\npassword = "' + piece * n
        t = time.thread_time()
        secret_scan.scan_text(text)
        took.append(time.thread_time() - t)
    assert took[1] < 9 * took[0] + 0.2 and took[1] < 30


def test_chain_of_names():
    text = 'token0 = "q"\n' + "".join(f"token{i + 1} = token{i} + 'x{i}'\n" for i in range(5000))
    t = time.thread_time()
    assert len(secret_scan.literals(text)) == 5001 and time.thread_time() - t < 10


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, f'secret = "{HIDDEN}"'), (3, "x" * 3_000_000 + f' token: "{HIDDEN}"'), (3, "a = b"), (3, "a = b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("clash"))
    got = docs.select("doc_id", F.size(secret_scan.spans(F.col("text"))).alias("n")).collect()
    assert sorted((r.doc_id or 0, r.n) for r in got) == [(0, 2), (1, 0), (2, 0), (3, 0), (3, 0), (3, 2)]
    assert docs.limit(0).select(secret_scan.spans(F.col("text"))).count() == 0
