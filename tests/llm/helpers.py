"""Awkward documents that every operator must take."""

import re

#: Columns whose names clash with those that operators use inside.
CLASHING = ("h", "rank", "ids", "n_tokens", "word", "taken", "toxic", "row", "id", "sha", "key", "low", "kept", "copies", "copy", "rk", "occ", "size", "held", "_id", "_sha", "_kept", "_kept_id", "_copies", "_rk", "_once", "_row")
EXTRA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def awkward():
    base = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix potions near the old stone bridge at dawn again"
    return [
        (1, base), (2, base), (3, base.replace(" fox", "\t\n fox")), (4, base + " indeed"), (5, None), (6, ""), (7, " \n\t "), (8, "word"), (9, "word"),
        (10, "x" * 50_000), (11, " ".join(f"w{i % 977}" for i in range(30_000))), (12, "ÉTÉ été İstanbul ΣΑΣ 日本語 😀 a.b,c don't 'll"),
        (13, "<|endoftext|> in the middle <|startoftext|>"), (14, "  two  spaces\n\nand\x0bbreaks\x1c\x85 "), (15, "You IDIOT, what an idiot"), (15, "You IDIOT, what an idiot"),
        (16, base.replace("lazy", "sleepy")), (17, "Mail a.b@c.de or a.b@c.d_e@f.gh, ip 1.2.3.4.5.6.7.8, card 4111 1111 1111 1111, tel +1 (209) 555-1594"),
    ]


def documents(spark, rows=None, extra=True):
    rows = awkward() if rows is None else rows
    full = [(i, t, "en" if i and i % 2 else None, None if i in (2, 9) else f"src{(i or 0) % 3}", len(t or ""), *(f"{c}{i}" for c in CLASHING)) for i, t in rows]
    df = spark.createDataFrame(full, EXTRA)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


def test_tables(spark):
    """Awkward rows, an empty table, and a table with a null id."""
    return documents(spark), documents(spark, []), documents(spark, [(None, "some text here"), (1, None)])


test_tables.__test__ = False
