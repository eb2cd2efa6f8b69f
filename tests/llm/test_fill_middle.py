import hashlib
import random
import re

import pytest

from tidepool.llm import fill_middle as M
from tidepool.llm.fill_middle import fill_in_middle, rebuild

TOKEN = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(key, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return key, n, "plain", None, None, text
    if h4 % 100 < 80:
        return key, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return key, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts(n, seed):
    rng = random.Random(seed)
    pieces = ["a", "bé", "日本", "😀", " ", "  ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", " ", " ", "x" * 20, "<", "P>", "<P>", "<S", "M>"]
    weights = [10] * 15 + [1] * 5
    return [(i, "".join(rng.choices(pieces, weights, k=rng.randint(0, 30)))) for i in range(n)]


ROWS = texts(600, 1) + [(900, None), (901, ""), (902, " "), (903, "one"), (None, "some words here"), (5, "again"), (5, "again"),
                        (904, "é" * 70000), (905, "word " * 40000), (906, "\n" * 50)]


def test_equals_brute_force_and_gives_the_text_back(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(4)
    got = rebuild(fill_in_middle(df)).collect()
    want = sorted((brute(*r) for r in ROWS), key=repr)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=repr) == want
    assert sorted(((r.doc_id, r.restored) for r in got), key=repr) == sorted(((k, t or "") for k, t in ROWS), key=repr)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_scatter_and_gather_in_blocks(monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK_BYTES", block)
    rng = random.Random(block)
    for _ in range(200):
        rows = [(rng.choice(["plain", "psm", "spm"]), bytes(rng.choices(range(97, 123), k=rng.randint(0, 9)))) for _ in range(5)]
        cuts, want, start = [], [], 0
        for form, t in rows:
            a, b = sorted((rng.randint(0, len(t)), rng.randint(0, len(t))))
            cuts.append((form, start, start + a, start + b, start + len(t)))
            want.append(t if form == "plain" else b"<P>" + t[:a] + b"<S>" + t[b:] + b"<M>" + t[a:b] if form == "psm"
                        else b"<S>" + t[b:] + b"<P>" + t[:a] + b"<M>" + t[a:b])
            start += len(t)
        out, ends = M.scatter(M.np.frombuffer(b"".join(t for _, t in rows), M.np.uint8), cuts)
        got = [bytes(out[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        assert got == want
        back, ends = M.gather(got, [f for f, _ in rows])
        assert [bytes(back[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)] == [t for _, t in rows]


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([(3, "one two three", "x", 1, 2)], "doc_id long, text string, form string, n int, id int")
    assert fill_in_middle(df.where("doc_id < 0")).count() == 0
    assert rebuild(fill_in_middle(df)).select("doc_id", "restored").collect() == [(3, "one two three")]
    named = df.select("doc_id", "text").toDF("output", "form")
    got = fill_in_middle(named, "output", "form")
    assert got.columns.count("output") == 2  # the id keeps its name
    renamed = rebuild(fill_in_middle(df).withColumnRenamed("form", "f").withColumnRenamed("output", "o"), "f", "o", "doc_id")
    assert renamed.first().doc_id == "one two three"
