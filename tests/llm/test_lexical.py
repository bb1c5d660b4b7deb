import math
import re
from collections import Counter

import pytest

from readloom.llm import lexical
from readloom.llm.queries import QUERIES
from tests.llm.helpers import ascii_lower, awkward, documents
from tests.llm.helpers import test_tables as tables_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, items, k=10):
    docs = [(i, Counter(TERM.findall(ascii_lower(t or "")))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(TERM.findall(ascii_lower(t or "")))
    out = []
    for item, terms in asked.items():
        found = []
        for i, c in docs:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "item_id long, text string, doc_id string, rank string")


ITEMS = [(1, "The lazy dog, the IDIOT!"), (1, "The lazy dog, the IDIOT!"), (2, None), (3, ""), (4, "zzzunknown"), (5, "word w1 w2 w3 w400"), (6, "ÉTÉ 日本語"), (6, "mail 4111"), (None, "seven wizards"), (7, "a a a x-y_z")]


@pytest.mark.parametrize("block", [3, 8192])
def test_awkward_rows(spark, monkeypatch, block):
    monkeypatch.setattr(lexical, "BLOCK", block)
    docs, empty, null = tables_of(spark)
    items = items_of(spark, ITEMS)
    assert result(lexical.ranked_search(docs, items)) == brute(awkward(), ITEMS)
    assert result(lexical.ranked_search(empty, items)) == [] and result(lexical.ranked_search(docs, items.limit(0))) == []
    assert result(lexical.ranked_search(null, items_of(spark, [(1, "some text")]))) == brute([(None, "some text here"), (1, None)], [(1, "some text")])


def test_ties_floods_and_blocks_of_items(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[(i * 7 + j * j) % 60] for j in range(1 + i % 23))) for i in range(700)]
    rows += [(2000 - i, "w1 w2 w3 hot copies") for i in range(300)] + [(None, "w1 w2 w3 hot copies")]
    items = [(i, " ".join(words[(i * 3 + j * 5) % 60] for j in range(2 + i % 9))) for i in range(40)] + [(99, "w1 hot w3 w2")]
    monkeypatch.setattr(lexical, "ITEMS", 8)
    monkeypatch.setattr(lexical, "BLOCK", 64)
    monkeypatch.setattr(lexical, "HELD", 200)
    assert result(lexical.ranked_search(documents(spark, rows).repartition(3), items_of(spark, items), k=7)) == brute(rows, items, 7)


def test_masks_stop_early():
    """Groups that can't reach the floor are never scored."""
    import numpy as np

    ids = np.arange(4000)
    row = np.repeat(ids, 2)
    term = np.where(np.arange(8000) % 2, 1 + (row % 3 == 0), 0).astype(np.int64)
    term[row == 77] = [2, 3]
    gain = np.where(term == 3, 1000, 10).astype(np.int64)
    block = lexical.MaskBlock(ids, row, term, gain, 4)
    seen = []
    plain = block.scores
    block.scores = lambda g: seen.append(g.bit_count()) or plain(g)
    assert block.search(np.array([0, 1, 2, 3]), [], 1) == [(-1010, 77)] and sum(seen) == 1


def test_registered_query_on_small_tables(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert result(QUERIES["op12_mask_search"](spark, sf_dir)) == brute(rows, items)
