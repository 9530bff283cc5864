"""Text preparation as column expressions over one row's text.

A work's text stays in its row: blocks are an array column and every rule is a
function over that array, so preparing a corpus is a narrow, shuffle-free map
no matter how long or how skewed the works are.

Rules that look along the sequence of blocks (a run after a contents heading,
a tail of end marks, a pair of quotes) classify each element as one letter,
match a regex over the string of letters, and read the answer back element by
element.  That keeps them linear in the number of blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmeter import fixed_values as fixed
from inkmeter.functions.strings import (
    LINE_END,
    TO_END,
    WHITE,
    count_matches,
    is_blank,
    let,
    lines,
    matches_all,
    rstrip,
    strip,
)

# --- Bytes to text ---------------------------------------------------------

_HIGH = range(0x80, 0xA0)
_LATIN1_CONTROLS = "".join(chr(b) for b in _HIGH)
_CP1252_CHARS = "".join(bytes([b]).decode("cp1252", errors="replace") for b in _HIGH)


def decode_text(content: Column) -> Column:
    """UTF-8 without byte-order mark, else Windows-1252 with replacement."""
    as_text = content.cast("string")
    fallback = F.translate(F.decode(content, "iso-8859-1"), _LATIN1_CONTROLS, _CP1252_CHARS)
    return F.when(
        F.is_valid_utf8(as_text), F.regexp_replace(as_text, "\\A\ufeff", "")
    ).otherwise(fallback)


def unix_newlines(value: Column) -> Column:
    return F.regexp_replace(value, r"\r\n?", "\n")


# --- Body between the boilerplate markers ----------------------------------


def after_start(
    value: Column,
    start: str = fixed.BODY_START,
    old_start: str = fixed.BODY_START_OLD,
) -> Column:
    """Text after the first modern start marker, else after an old one, else null."""
    return F.coalesce(
        F.get(F.split(value, start, 2), 1), F.get(F.split(value, old_start, 2), 1)
    )


def before_end(value: Column, end: str = fixed.BODY_END) -> Column:
    """Text before the earliest end marker; null when there is none."""
    parts = F.split(value, end, 2)
    return F.when(F.size(parts) == 2, F.get(parts, 0))


def body_status(value: Column) -> Column:
    """'ok', or which marker is missing."""
    rest = after_start(value)
    return (
        F.when(rest.isNull(), "no start marker")
        .when(before_end(rest).isNull(), "no end marker")
        .otherwise("ok")
    )


def isolate_body(value: Column) -> Column:
    return before_end(after_start(value))


def strip_notes(value: Column) -> Column:
    """Bracketed illustration/transcriber notes and e-text number lines."""
    return F.regexp_replace(
        F.regexp_replace(value, fixed.BRACKET_NOTE, ""), fixed.ETEXT_LINE, ""
    )


# --- Blocks ----------------------------------------------------------------


def split_blocks(value: Column) -> Column:
    """Blank-line separated blocks, empty ones dropped."""
    return F.transform(
        F.filter(F.split(value, r"\n[ \t]*\n"), lambda b: ~is_blank(b)),
        lambda b: strip(b, "\n"),
    )


def _codes(blocks: Column, code) -> Column:  # noqa: ANN001
    return F.array_join(F.transform(blocks, code), "")


def _keep_coded(blocks: Column, codes: Column, dropped: str) -> Column:
    """Elements whose letter in the code string is not the dropped one."""
    pairs = F.arrays_zip(blocks.alias("block"), F.split(codes, "").alias("code"))
    kept = F.filter(pairs, lambda p: p["code"] != dropped)
    return F.transform(kept, lambda p: p["block"])


def _contents_code(block: Column) -> Column:
    """h: contents heading, l: list-like block, t: anything else."""
    rows = F.transform(F.array(block), lambda b: lines(b))
    return F.transform(
        rows,
        lambda ls: F.when(strip(F.get(ls, 0)).rlike(fixed.CONTENTS_HEADING), "h")
        .when(
            (F.size(ls) >= fixed.CONTENTS_MIN_LINES)
            & F.forall(ls, lambda x: F.length(x) <= fixed.CONTENTS_MAX_LINE_CHARS),
            "l",
        )
        .otherwise("t"),
    )[0]


def drop_contents(blocks: Column) -> Column:
    """Drop contents headings and the list-like blocks that follow each."""
    codes = F.concat(F.lit("t"), _codes(blocks, _contents_code))
    # h drops itself; an l drops when the block just before it was dropped
    marked = F.substring(F.regexp_replace(codes, r"h|\Gl", "x"), 2, TO_END)
    return _keep_coded(blocks, marked, "x")


def squash(value: Column) -> Column:
    """Lower-case letters and digits, everything else one space."""
    return F.trim(F.regexp_replace(F.lower(value), "[^a-z0-9]+", " "))


def is_front_matter(block: Column, title: Column, author: Column) -> Column:
    """The block repeats the title or author, or is a credit or an imprint."""
    main_title = squash(F.split(title, r"[:;\n\r]")[0])
    names = F.filter(
        F.transform(F.split(author, ";"), lambda n: squash(n)),
        lambda n: (F.length(n) >= 4) & (n != "unknown"),
    )
    stripped, squashed = strip(block), squash(block)
    rows = F.transform(lines(stripped), lambda x: strip(x, " \t_*"))
    echoes = (
        ((F.length(squashed) >= 4) | (squashed == main_title))
        & F.contains(squash(title), squashed)
    ) | ((F.length(main_title) >= 4) & F.contains(squashed, main_title))
    line_dirt = (F.size(rows) <= fixed.FRONT_MAX_LINES) & (
        echoes
        | F.exists(names, lambda n: F.contains(squashed, n))
        | F.forall(rows, lambda x: x.rlike(fixed.FRONT_CUE_LINE))
        | F.exists(rows, lambda x: x.rlike(fixed.FRONT_STRONG_LINE))
        | F.get(rows, 0).rlike(fixed.CREDIT_LINE)
    )
    short = F.length(block) <= fixed.FRONT_MAX_CHARS
    return (
        block.rlike(fixed.SOURCE_MENTION)
        | stripped.rlike(fixed.BRACKET_BLOCK)
        | (short & (block.rlike(fixed.DEDICATION) | line_dirt))
    )


def drop_front_matter(blocks: Column, title: Column, author: Column) -> Column:
    """Front matter sits in the opening blocks only; the rest passes as is."""
    opening = F.slice(blocks, 1, fixed.FRONT_BLOCKS)
    return F.concat(
        F.filter(opening, lambda b: ~is_front_matter(b, title, author)),
        F.slice(blocks, fixed.FRONT_BLOCKS + 1, TO_END),
    )


def drop_tail(blocks: Column) -> Column:
    """Drop the closing run of end marks."""
    codes = _codes(
        blocks, lambda b: F.when(strip(b).rlike(fixed.TAIL_BLOCK), "e").otherwise("t")
    )
    kept = F.length(F.regexp_replace(codes, r"e+\z", ""))
    return F.slice(blocks, F.lit(1), kept)


# --- Headings and rendering ------------------------------------------------


def is_caps_line(line: Column) -> Column:
    letters = F.length(F.regexp_replace(line, r"\P{L}", ""))
    return (
        (line == F.upper(line))
        & F.length(line).between(3, fixed.HEADING_MAX_CHARS)
        & (letters >= 3)
        & ~line.rlike(r"[.!?]\z")
    )


def _stripped_lines(block: Column) -> Column:
    return F.transform(lines(block), lambda x: strip(x))


def _lines_are_heading(rows: Column) -> Column:
    first = F.get(rows, 0)
    return (
        F.size(rows).between(1, fixed.HEADING_MAX_LINES)
        & F.forall(rows, lambda x: F.length(x) <= fixed.HEADING_MAX_CHARS)
        & (
            first.rlike(fixed.HEADING_KEYWORD)
            | first.rlike(fixed.HEADING_WORD)
            | first.rlike(fixed.HEADING_NUMBER)
            | is_caps_line(first)
        )
    )


def is_heading(block: Column) -> Column:
    """One or two short lines opening with a chapter word, number or capitals."""
    return F.coalesce(
        F.transform(F.array(_stripped_lines(block)), lambda r: _lines_are_heading(r))[0],
        F.lit(False),
    )


def unwrap(block: Column) -> Column:
    """Join wrapped lines; an indented continuation is verse and keeps its shape."""
    rows = F.split(block, LINE_END)
    is_verse = F.exists(F.slice(rows, 2, TO_END), lambda x: x.rlike(r"\A[ \t]"))
    return F.when(
        is_verse, F.array_join(F.transform(rows, lambda x: rstrip(x)), "\n")
    ).otherwise(F.array_join(F.transform(rows, lambda x: strip(x)), " "))


def describe_blocks(blocks: Column) -> Column:
    """Per block what rendering asks about it."""
    with_lines = F.transform(
        blocks, lambda b: F.struct(b.alias("block"), _stripped_lines(b).alias("rows"))
    )
    return F.transform(
        with_lines,
        lambda s: F.struct(
            s["block"].alias("block"),
            s["rows"].alias("rows"),
            _lines_are_heading(s["rows"]).alias("heading"),
            strip(s["block"]).alias("stripped"),
            (F.length(s["block"]) > fixed.SUBTITLE_NEXT_OVER).alias("long"),
        ),
    )


def render_described(described: Column) -> Column:
    """Blocks as markdown: headings, merged subtitles, unwrapped paragraphs.

    ``described`` must be a plain column (see ``describe_blocks``): it is read
    at four offsets.
    """
    none = F.get(described, -1)  # a null of the element type
    around = F.arrays_zip(
        described.alias("here"),
        F.slice(F.concat(F.array(none), described), F.lit(1), F.size(described)).alias("prev"),
        F.slice(described, 2, TO_END).alias("next"),
        F.slice(described, 3, TO_END).alias("after"),
    )

    def takes_subtitle(head: Column, sub: Column, after: Column) -> Column:
        return F.coalesce(
            head["heading"]
            & (F.size(head["rows"]) == 1)
            & ~sub["heading"]
            & ~F.contains(sub["stripped"], F.lit("\n"))
            & F.length(sub["stripped"]).between(1, fixed.SUBTITLE_MAX_CHARS)
            & after["long"],
            F.lit(False),
        )

    def render(w: Column) -> Column:
        here, rows = w["here"], w["here"]["rows"]
        first = F.get(rows, 0)
        head = F.concat(F.lit("## "), rstrip(first, ".:"), F.lit(": "))
        return (
            F.when(takes_subtitle(w["prev"], here, w["next"]), F.lit(None).cast("string"))
            .when(~here["heading"], unwrap(here["block"]))
            .when(F.size(rows) == 2, F.concat(head, F.get(rows, 1)))
            .when(
                takes_subtitle(here, w["next"], w["after"]),
                F.concat(head, w["next"]["stripped"]),
            )
            .otherwise(F.concat(F.lit("## "), first))
        )

    # array_join leaves the null of a block that rode along as a subtitle out
    return F.concat(F.array_join(F.transform(around, render), "\n\n"), F.lit("\n"))


# --- Single-quote dialogue -------------------------------------------------


def has_single_dialogue(body: Column) -> Column:
    singles = count_matches(body, fixed.SINGLE_QUOTE_OPENING)
    doubles = count_matches(body, f'[{fixed.STRAIGHT_QUOTE}{fixed.OPEN_QUOTE}]')
    return (singles >= fixed.SINGLE_QUOTE_MIN) & (singles > fixed.SINGLE_QUOTE_TIMES * doubles)


def convert_single_dialogue(paragraph: Column) -> Column:
    """Turn paired straight single quotes of one paragraph into curly doubles."""
    pieces = F.split(paragraph, "'")
    quotes = F.arrays_zip(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1).alias("before"),
        F.slice(pieces, 2, TO_END).alias("behind"),
    )
    last = F.size(pieces) - 2

    def code(q: Column, i: Column) -> Column:
        """o: can open, c: can close, b: both, n: neither."""
        starts = (i == 0) & (q["before"] == "")
        opens = (
            (starts | q["before"].rlike(r"[ \t\n(—\-_]\z"))
            & q["behind"].rlike(r"\A[\p{L}_]")
            & ~q["behind"].rlike(fixed.DIALECT_WORD)
        )
        closes = q["before"].rlike(r"[.,!?;:—\-_)]\z") | (
            q["before"].rlike(r"\p{L}\z") & (q["behind"] == "") & (i == last)
        )
        return (
            F.when(opens & closes, "b").when(opens, "o").when(closes, "c").otherwise("n")
        )

    codes = F.array_join(F.transform(quotes, code), "")
    # An opener runs to the next closer, or to the end of the paragraph
    paired = F.regexp_replace(codes, r"[ob]([^cb]*)([cb]|\z)", "<$1>$2")
    marked = F.regexp_replace(F.regexp_replace(paired, ">[cb]", "="), ">", "")
    # Restore one letter per quote: '<' opened, '=' closed
    signs = F.split(marked, "")
    rejoined = F.transform(
        F.arrays_zip(quotes.alias("quote"), signs.alias("sign")),
        lambda z: F.concat(
            F.when(z["sign"] == "<", fixed.OPEN_QUOTE)
            .when(z["sign"] == "=", fixed.CLOSE_QUOTE)
            .otherwise("'"),
            z["quote"]["behind"],
        ),
    )
    return F.when(
        F.size(pieces) > 1, F.concat(F.get(pieces, 0), F.array_join(rejoined, ""))
    ).otherwise(paragraph)


def curl_dialogue(body: Column) -> Column:
    """Convert every paragraph of a body that speaks in single quotes."""
    converted = F.array_join(
        F.transform(F.split(body, "\n\n"), lambda p: convert_single_dialogue(p)), "\n\n"
    )
    return F.when(has_single_dialogue(body), converted).otherwise(body)


def rewrite_emphasis(value: Column) -> Column:
    return F.regexp_replace(value, fixed.EMPHASIS, "*$1*")


# --- Markdown to prose -----------------------------------------------------


def clean_markdown(
    raw: Column, rules: Sequence[tuple[str, str]] = fixed.MARKDOWN_RULES
) -> Column:
    """Plain prose: the ordered rules, then trimmed; prose punctuation stays."""
    value = unix_newlines(raw)
    for pattern, replacement in rules:
        value = _apply_rule(value, pattern, replacement)
    return strip(value)


def _apply_rule(value: Column, pattern: str, replacement: str) -> Column:
    """A link needs "](": without one, a text of brackets is not searched for it."""
    if r"\]\(" not in pattern:
        return F.regexp_replace(value, pattern, replacement)
    return let(
        value,
        lambda v: F.when(
            F.contains(v, F.lit("](")), F.regexp_replace(v, pattern, replacement)
        ).otherwise(v),
    )


# --- Paragraphs and chunks -------------------------------------------------


def split_paragraphs(value: Column) -> Column:
    return F.split(value, rf"\n[{WHITE}]*\n")


# How a chunk ends: with its paragraph, with a sentence of it, at white space or anywhere
PARAGRAPH, SENTENCE, SPACE = 0, 1, 2
CLOSING = "[\"”’)\\]]"


def cut_text(value: Column, max_chars: int = fixed.MAX_CHUNK_CHARS) -> Column:
    """Array of (chunk, ends): the text in chunks of at most ``max_chars`` characters.

    Whole paragraphs are packed.  A paragraph that is longer is cut behind its
    last sentence that fits, a sentence that is longer at its last white space
    that fits, and what has none after ``max_chars`` characters.  ``ends`` says
    which it was, and is ``PARAGRAPH`` for the last chunk.  Every character
    of a paragraph stays; white space at a cut begins the next chunk.
    """
    joined = F.array_join(split_paragraphs(value), "\n\n")
    marks = min(63, max_chars // 4)  # closing marks that a sentence may end with
    pattern = (
        rf"(?s).{{0,{max_chars}}}(?=\n\n|\z)(?:\n\n|\z)"
        rf"|.{{0,{max_chars - marks - 1}}}[.!?]{CLOSING}{{0,{marks}}}(?=\s)"
        rf"|.{{0,{max_chars - 1}}}\S(?=\s)"
        rf"|.{{1,{max_chars}}}"
    )

    def ended(chunk: Column, last: Column) -> Column:
        by_paragraph = chunk.endswith("\n\n")
        return F.struct(
            F.when(by_paragraph, chunk.substr(F.lit(1), F.length(chunk) - 2))
            .otherwise(chunk)
            .alias("chunk"),
            F.when(last | by_paragraph, PARAGRAPH)
            .when(chunk.rlike(rf"[.!?]{CLOSING}*\z"), SENTENCE)
            .otherwise(SPACE)
            .alias("ends"),
        )

    # The scan ends with one empty match at the very end of the text
    packed = F.filter(matches_all(joined, pattern), lambda chunk: chunk != "")
    whole = F.array(F.struct(joined.alias("chunk"), F.lit(PARAGRAPH).alias("ends")))
    cut = let(
        packed,
        lambda chunks: F.filter(
            F.transform(chunks, lambda c, i: ended(c, i == F.size(chunks) - 1)),
            lambda c: c["chunk"] != "",
        ),
    )
    return F.when(F.length(joined) <= max_chars, whole).otherwise(cut)


def chunk_text(value: Column, max_chars: int = fixed.MAX_CHUNK_CHARS) -> Column:
    """The chunks of ``cut_text``."""
    return F.transform(cut_text(value, max_chars), lambda c: c["chunk"])
