"""Text preparation on small texts with written-out results."""

import random
import re

import pytest
from pyspark.sql import functions as F

from inkmeter.functions import prose
from inkmeter.operators import prepare


def value(spark, column, **columns):
    schema = ", ".join(
        f"{k} {'binary' if isinstance(v, bytes | bytearray) else 'string'}" for k, v in columns.items()
    )
    return spark.createDataFrame([tuple(columns.values())], schema).select(column.alias("v")).first().v


def test_decode(spark):
    decoded = prose.decode_text(F.col("c"))
    assert value(spark, decoded, c=bytearray("﻿café".encode())) == "café"
    assert value(spark, decoded, c=bytearray("“café” –".encode("cp1252"))) == "“café” –"
    assert value(spark, decoded, c=bytearray(b"ok \x81 end\xff")) == "ok � endÿ"


def test_headings(spark):
    cases = {
        "CHAPTER I": True,
        "Chapter 1. The Road": True,
        "XIV.": True,
        "12": True,
        "II. The House": True,
        "II. The house was old.": False,
        "THE OLD HOUSE": True,
        "THE OLD HOUSE.": False,
        "Author's Note": True,
        "Partly cloudy": False,
        "It was late": False,
        "BOOK ONE\nThe Start": True,
        "BOOK ONE\nThe Start\nMore": False,
        "CHAPTER " + "x" * 60: False,
    }
    rows = spark.createDataFrame(list(cases.items()), "block string, want boolean")
    got = rows.withColumn("got", prose.is_heading(F.col("block"))).collect()
    assert [(r.block, r.got) for r in got] == [(r.block, r.want) for r in got]


def test_unwrap(spark):
    got = prose.unwrap(F.col("b"))
    assert value(spark, got, b=" one\ntwo  \nthree") == "one two three"
    assert value(spark, got, b="one  \n  two\nthree ") == "one\n  two\nthree"


def test_contents_run(spark):
    listed = "I. One\nII. Two\nIII. Three"
    blocks = F.array(*[F.lit(b) for b in ["start", "CONTENTS", listed, listed, "text", listed]])
    got = spark.range(1).select(prose.drop_contents(blocks).alias("v")).first().v
    assert got == ["start", "text", listed]


def raw_file(body):
    return (
        "Header\r\n*** START OF THE PROJECT GUTENBERG EBOOK X ***\r\n\r\n"
        + body.replace("\n", "\r\n")
        + "\r\n\r\nTHE END\r\n\r\n*** END OF THE PROJECT GUTENBERG EBOOK X ***\r\nLicense"
    ).encode()


def test_to_markdown(spark):
    long = "It was a dark night " * 10
    body = (
        "The Road\n\nBy Clark Smythe\n\n[Illustration: map\nof it]\n\nCHAPTER I.\n\nThe _Gate_\n\n"
        f"{long}\nand on\n\nPART\nTwo\n\nShort."
    )
    rows = [
        ("1", bytearray(raw_file(body)), "The Road", "Smythe, Clark, 1893-1961"),
        ("2", bytearray(b"no markers"), "T", "A"),
        ("3", bytearray(b"*** START OF THIS PROJECT GUTENBERG EBOOK X ***\ntext"), "T", None),
    ]
    files = spark.createDataFrame(rows, "work_id string, content binary, title string, authors string")
    got = {r.work_id: r for r in prepare.to_markdown(files).collect()}
    assert got["1"].status == "ok"
    assert got["1"].markdown == (
        "# The Road\n\n*Clark Smythe*\n\n---\n\n## CHAPTER I: The *Gate*\n\n"
        f"{long.strip()} and on\n\n## PART: Two\n\nShort.\n"
    )
    assert (got["2"].status, got["2"].markdown) == ("no start marker", None)
    assert got["3"].status == "no end marker"
    roster = spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "work_id string")
    audit = prepare.strip_outcomes(roster, prepare.to_markdown(files), "2024-01-01 00:00:00").first()
    assert (audit.roster_size, audit.stripped, audit.failed, audit.missing_text) == (4, 1, 2, 1)


def test_single_quote_pairs(spark):
    got = prose.convert_single_dialogue(F.col("p"))
    cases = {
        "'Go,' he said, 'now.'": "“Go,” he said, “now.”",
        "'Tis late, don't you think?": "'Tis late, don't you think?",
        "'It can't be,' she said": "“It can't be,” she said",
        "'Unclosed speech": "“Unclosed speech",
        "the dogs' tails": "the dogs' tails",
        "'Wait—' 'No!'": "“Wait—” “No!”",
        "no quotes": "no quotes",
        "he said 'yes'": "he said “yes”",
    }
    for text, want in cases.items():
        assert value(spark, got, p=text) == want, text


def scan_quotes(paragraph):
    """Brute force: walk the quotes once, remembering whether one is open."""
    dialect = {"tis", "twas", "em", "e", "im", "er", "un", "ere", "ave", "ow"}
    pieces, out, is_open = paragraph.split("'"), [], False
    out.append(pieces[0])
    for n, behind in enumerate(pieces[1:], 1):
        before = pieces[n - 1][-1:] or ("'" if n > 1 else " ")
        word = ""
        for ch in behind:
            if not (ch.isalnum() or ch == "_"):
                break
            word += ch
        sign = "'"
        if not is_open and before in " \t\n(—-_" and behind[:1] and (behind[0].isalpha() or behind[0] == "_"):
            if word.lower() not in dialect:
                sign, is_open = "“", True
        elif is_open and (
            before in ".,!?;:—-_)" or (before.isalpha() and behind == "" and n == len(pieces) - 1)
        ):
            sign, is_open = "”", False
        out.append(sign + behind)
    return "".join(out)


def test_single_quotes_against_brute_force(spark):
    rng = random.Random(7)
    parts = ["'", "'", "a", "em", " ", ".", ",", "—", "-", "(", "_", "tis", "Go", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(600)]
    rows = spark.createDataFrame([(t,) for t in texts], "p string")
    got = rows.select("p", prose.convert_single_dialogue(F.col("p")).alias("v")).collect()
    for r in got:
        assert r.v == scan_quotes(r.p), r.p


def test_curl_needs_enough_single_quotes(spark):
    few = "'Go,' he said."
    many = "\n\n".join(["'Go,' he said."] * 30)
    assert value(spark, prose.curl_dialogue(F.col("b")), b=few) == few
    assert value(spark, prose.curl_dialogue(F.col("b")), b=many) == many.replace("'Go,'", "“Go,”")


def test_clean_markdown(spark):
    raw = (
        "---\ntitle: x\n---\n# Title\n**By Me**\n\n* Source: y\n\n## One\r\n> *Quoted* __words__\n"
        "* * *\n[link](u) ![img](v) `code` _it_\n\n\n\n-----\nend  "
    )
    assert value(spark, prose.clean_markdown(F.col("b")), b=raw) == (
        "Quoted words\n\nlink  code it\n\nend"
    )


def cut_brute(text, most):
    """Chunks and how they end, by trying every place to cut."""
    marks = min(63, most // 4)
    out = []
    while text:
        window = [k for k in range(min(most, len(text)) + 1) if text.startswith("\n\n", k) or k == len(text)]
        ends, skip = prose.PARAGRAPH, 2
        if not window:
            skip = 0
            sentence = [
                k for k in range(1, min(most, len(text) - 1) + 1)
                if text[k].isspace() and (m := re.search(r"[.!?]([\"”’)\]]*)\Z", text[:k]))
                and len(m[1]) <= marks and k - len(m[1]) <= most - marks
            ]
            spaces = [k for k in range(1, min(most, len(text) - 1) + 1) if text[k].isspace() and not text[k - 1].isspace()]
            window = sentence or spaces or [min(most, len(text))]
            ended = re.search(r"[.!?][\"”’)\]]*\Z", text[: window[-1]])
            ends = prose.SENTENCE if ended else prose.SPACE
        at = window[-1]
        whole = at == len(text) and text.endswith("\n\n")
        out.append((text[: at - 2 * whole], ends))
        text = text[at + skip :]
    out = [c for c in out if c[0]]
    return [*out[:-1], (out[-1][0], prose.PARAGRAPH)] if out else [("", prose.PARAGRAPH)]


@pytest.mark.parametrize("most", [12, 40])
def test_chunks_against_brute_force(spark, most):
    rng = random.Random(4)
    pieces = ["ab", "c d", "efghijkl", "\n\n", "\n", " ", ". ", "!\") ", "?", "long" * 5, "«é” "]
    texts = ["", "\n\n", "   ", "x" * 100, "." * 30, *("".join(rng.choices(pieces, k=rng.randint(1, 60))) for _ in range(400))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in rows.select("t", prose.cut_text(F.col("t"), most).alias("v")).collect():
        joined = re.sub(r"\n\s*\n", "\n\n", r.t)
        want = cut_brute(joined, most) if len(joined) > most else [(joined, prose.PARAGRAPH)]
        assert [tuple(c) for c in r.v] == want, (r.t, r.v, want)
        assert all(len(c.chunk) <= most for c in r.v)
