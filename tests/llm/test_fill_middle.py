"""Fill-in-middle against a slow version in plain Python, the SQL, and its own inverse."""

from __future__ import annotations

import hashlib
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm import fill_middle, queries

TEXTS = [
    None, "", "\n", "\n\n\n", "a", "a\n", "a\nb", "é\n\nüß🙂\n" * 5, "x" * 17, "1234567\n12345678\n", "\r\n\r\n\x85 y",
    "has <P> in it\nand more", "<S>", "no <M", "ends in <", "<\nP>\n<", "0\n" * 70_000 + "tail", "same\ntext\n", "same\ntext\n",
    "\x00\n\x0b\n\x0c", "日本語\n" * 999,
]


def slow(doc, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = ("".join(units[x]) for x in (slice(a), slice(a, b), slice(b, None)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return len(units), "plain", text, None, None
    if h[3] % 100 < 50:
        return len(units), "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle)
    return len(units), "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle)


def test_every_form_against_the_slow_version(spark):
    rows = [(None if i == 5 else i * 37 - 60, t, "clash", "clash") for i, t in enumerate(TEXTS * 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, digest string, output string").repartition(3)
    out = fill_middle.transformed(frame)
    got = sorted(((r.doc_id, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in out.collect()), key=repr)
    assert got == sorted(((d, *slow(d, t)) for d, t, *_ in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    digests = fill_middle.digests(out).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert sorted((r.doc_id, r.restored_sha256) for r in digests if r.doc_id is not None) == sorted(
        (d, sha(t)) for d, t, *_ in rows if d is not None
    )


def test_rates_and_other_sentinels(spark):
    frame = spark.createDataFrame([(i, f"one {i}\ntwo [S]\nthree") for i in range(400)], "doc_id long, text string")
    forms = [r.form for r in fill_middle.transformed(frame, rate=30, spm_share=0).collect()]
    assert 70 < forms.count("psm") < 170 and set(forms) == {"psm", "plain"}
    assert {r.form for r in fill_middle.transformed(frame, sentinels=("[P]", "[S]", "[M]")).collect()} == {"plain"}
    signs = ("(.", "|", "\\E")
    out = fill_middle.transformed(frame, sentinels=signs)
    back = out.select("doc_id", fill_middle.restored(out.output, out.form, signs).alias("text"))
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in frame.collect()}


def test_no_rows(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert fill_middle.digests(fill_middle.transformed(frame)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("a\né🙂", max_size=30), min_size=1, max_size=8), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_cuts_of_a_block(texts, first, second):
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(r) for r in raw])
    starts = ends - [len(r) for r in raw]
    draws = (np.full(len(raw), first), np.full(len(raw), second))
    got = fill_middle.cuts(np.frombuffer(b"".join(raw), np.uint8), starts, ends, *draws)
    for i, text in enumerate(texts):
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        a, b = sorted((first % (len(units) + 1), second % (len(units) + 1)))
        prefix, middle = "".join(units[:a]), "".join(units[a:b])
        places = starts[i] + len(prefix.encode()), starts[i] + len((prefix + middle).encode())
        assert tuple(x[i] for x in got) == (len(units), *places, len(prefix), len(middle))


@pytest.mark.parametrize("block", [1, 64, 1 << 24])
def test_blocks_of_any_size(spark, block, monkeypatch):
    monkeypatch.setattr(fill_middle, "BLOCK_BYTES", block)
    rows = list(enumerate(TEXTS[:16]))
    out = fill_middle.transformed(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert {r.doc_id: (r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in out} == {
        d: slow(d, t) for d, t in rows
    }


def test_query_against_sql(spark, tables):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tables}/documents.parquet'")
    got = queries.op11_swar_fill_middle(spark, tables)
    want = connection.sql(queries.ORACLES["op11_swar_fill_middle"])
    assert sorted(got.columns) == sorted(want.columns)
    rows = [tuple(r[c] for c in want.columns) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(want.fetchall(), key=repr)
