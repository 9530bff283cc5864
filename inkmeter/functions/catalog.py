"""Catalog column builders: scope, genre, dedup keys, authors, flags, labels."""

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from inkmeter import fixed_values as fixed
from inkmeter.functions.strings import WHITE, strip, text

LIST_SEPARATOR = "; "


# --- Scope and genre -------------------------------------------------------


def shelf_token(pattern: str, column: str = "bookshelves") -> Column:
    """True when one whole element of the '; ' list matches the pattern."""
    return text(column).rlike(rf"(^|; ){pattern}(\z|;)")


def subject_has(pattern: str, column: str = "subjects") -> Column:
    return text(column).rlike(pattern)


def sf_core() -> Column:
    return subject_has(fixed.SF_SUBJECT) | shelf_token(fixed.SF_SHELF)


def fantasy_core() -> Column:
    return subject_has(fixed.FANTASY_SUBJECT) | shelf_token(fixed.FANTASY_SHELF)


def sff_shelf() -> Column:
    return shelf_token(fixed.SFF_SHELF)


def sf_theme() -> Column:
    return subject_has(fixed.SF_THEME_SUBJECT)


def fantasy_theme() -> Column:
    return subject_has(fixed.FANTASY_THEME_SUBJECT)


def horror_core() -> Column:
    return subject_has(fixed.HORROR_SUBJECT) | shelf_token(fixed.HORROR_SHELF)


def horror_theme() -> Column:
    return subject_has(fixed.HORROR_THEME_SUBJECT)


def horror() -> Column:
    return horror_core() | horror_theme()


def is_about(column: str = "subjects") -> Column:
    """Some subject element is about fiction rather than fiction itself."""
    return F.exists(
        F.split(text(column), LIST_SEPARATOR),
        lambda s: s.rlike(fixed.ABOUT_SUBJECT) & ~s.rlike(fixed.FICTION_SUBJECT),
    )


def in_scope(type_: str = "Text", language: str = "en") -> Column:
    """Core keyword or shelf, not about; a theme alone admits nothing."""
    admitted = sf_core() | fantasy_core() | sff_shelf() | horror()
    return (F.col("type") == type_) & (F.col("language") == language) & admitted & ~is_about()


def genre() -> Column:
    """The one family a work belongs to; several or none is undetermined."""
    families = (
        ("Sci-Fi", sf_core() | sf_theme()),
        ("Fantasy", fantasy_core() | fantasy_theme()),
        ("Horror", horror()),
    )
    hits = sum((hit.cast("int") for _, hit in families), F.lit(0))
    label = F.lit(None).cast("string")
    for name, hit in families:
        label = F.when(hit, F.lit(name)).otherwise(label)
    return F.when(hits == 1, label).otherwise(F.lit("Undetermined"))


# --- Dedup keys ------------------------------------------------------------


def title_key() -> Column:
    return F.lower(strip(text("title")))


def first_author_key() -> Column:
    return F.lower(strip(F.split(text("authors"), ";")[0]))


# --- Authors ---------------------------------------------------------------


def _first_author(column: str) -> Column:
    """First ';' entry with its [role] tags removed."""
    return F.regexp_replace(F.substring_index(F.col(column), ";", 1), r"\[[^\]]*\]", "")


def primary_author(column: str = "authors") -> Column:
    """First author without role and date segment; blank becomes 'Unknown'."""
    name = F.trim(F.regexp_replace(_first_author(column), r",[^,]*[0-9][^,]*\z", ""))
    return F.coalesce(F.nullif(name, F.lit("")), F.lit("Unknown"))


def birth_year(column: str = "authors") -> Column:
    year = F.regexp_extract(_first_author(column), r",\s*([0-9]{3,4})\??\s*-", 1)
    return F.nullif(year, F.lit("")).cast("int")


def death_year(column: str = "authors") -> Column:
    year = F.regexp_extract(_first_author(column), r"-\s*([0-9]{3,4})\??\s*\z", 1)
    return F.nullif(year, F.lit("")).cast("int")


def display_author(column: str = "authors") -> Column:
    """'Smith, Clark Ashton, 1893-1961 [Editor]' -> 'Clark Ashton Smith'.

    Role-tagged entries count only when nobody is untagged.
    """
    role, paren = r"\[[^\]]*\]", r"\([^)]*\)"
    date_part = r"(?iU)\d{4}|^[\d? –-]+$|\bcent(?:ury)?\b"
    entries = F.filter(
        F.transform(F.split(text(column), ";"), lambda e: strip(e)), lambda e: e != ""
    )
    people = F.when(
        F.exists(entries, lambda e: ~e.rlike(role)), F.filter(entries, lambda e: ~e.rlike(role))
    ).otherwise(entries)
    parts = F.transform(
        people,
        lambda e: F.filter(
            F.transform(
                F.split(F.regexp_replace(F.regexp_replace(e, paren, ""), role, ""), ","),
                lambda p: strip(p),
            ),
            lambda p: (p != "") & ~p.rlike(date_part),
        ),
    )
    names = F.transform(
        F.filter(parts, lambda p: F.size(p) > 0),
        lambda p: F.array_join(F.concat(F.slice(p, 2, F.size(p)), F.slice(p, 1, 1)), " "),
    )
    return F.coalesce(F.nullif(F.array_join(names, "; "), F.lit("")), F.lit("Unknown"))


def display_title(column: str = "title") -> Column:
    return F.regexp_replace(strip(text(column)), rf"[{WHITE}]*[\r\n]+[{WHITE}]*", ": ")


@F.pandas_udf(StringType())
def fold_to_ascii(values: pd.Series) -> pd.Series:
    """Compatibility-decompose and keep the ASCII part; Spark has no normaliser."""
    return values.str.normalize("NFKD").str.encode("ascii", "ignore").str.decode("ascii")


def author_folder(name: Column) -> Column:
    """Folder name of a display author."""
    folded = F.regexp_replace(fold_to_ascii(F.split(name, ";")[0]), "[^A-Za-z0-9]+", "-")
    return F.coalesce(F.nullif(strip(folded, "-"), F.lit("")), F.lit("Unknown"))


def title_slug(title: Column) -> Column:
    """First title segment as a slug of up to 60 characters."""
    head = F.lower(fold_to_ascii(F.split(title, r"[:;\n\r]")[0]))
    slug = F.substring(strip(F.regexp_replace(head, "[^a-z0-9]+", "-"), "-"), 1, 60)
    return F.coalesce(F.nullif(slug, F.lit("")), F.lit("untitled"))


# --- Work flags ------------------------------------------------------------


def _lower_has(column: str, *words: str) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.contains(F.lower(text(column)), F.lit(word))
    return found


def has_class_code(codes: Sequence[str], column: str = "locc") -> Column:
    """Some element of the '; ' class list starts with one of the codes."""
    return text(column).rlike(rf"(^|; )(?:{'|'.join(codes)})")


def is_translation() -> Column:
    hit = (
        _lower_has("authors", "translator")
        | _lower_has("subjects", "translations into english")
        | has_class_code(fixed.FOREIGN_CLASS_CODES)
    )
    return hit.cast("int")


def is_juvenile() -> Column:
    hit = has_class_code([fixed.JUVENILE_CLASS_CODE]) | _lower_has("subjects", "juvenile")
    return hit.cast("int")


def is_play() -> Column:
    hit = _lower_has("subjects", "drama", "plays") | _lower_has(
        "bookshelves", "plays/films/dramas"
    )
    return hit.cast("int")


def is_poetry() -> Column:
    return _lower_has("subjects", "poetry").cast("int")


# --- Measurement labels ----------------------------------------------------


def concept_of(series: Column) -> Column:
    """The concept a measured series belongs to."""
    concept = series
    for prefix, name in fixed.SERIES_FAMILIES.items():
        concept = F.when(series.startswith(prefix), F.lit(name)).otherwise(concept)
    return concept


def series_label(series: Column, concept: Column) -> Column:
    """Series name without its family prefix."""
    label = series
    for prefix, name in fixed.SERIES_FAMILIES.items():
        label = F.when(concept == name, F.replace(series, F.lit(prefix), F.lit(""))).otherwise(
            label
        )
    return label


def prose_type(words: Column) -> Column:
    """Size band of a work."""
    return (
        F.when(words < fixed.SHORT_STORY_BELOW, "short-story")
        .when(words < fixed.NOVELLA_BELOW, "novella")
        .otherwise("novel")
    )


def january_first(year: Column) -> Column:
    return F.when(year.isNotNull(), F.make_date(year, F.lit(1), F.lit(1)))


def empty_to_date(value: Column) -> Column:
    return F.nullif(value, F.lit("")).cast("date")


def has_marker(
    content: Column,
    marker: str = fixed.COPYRIGHT_MARKER,
    scan_bytes: int = fixed.MARKER_SCAN_BYTES,
) -> Column:
    """The marker occurs, in any case, in the first bytes of a file."""
    head = F.decode(F.substring(content, 1, scan_bytes), "iso-8859-1")
    return F.contains(F.lower(head), F.lit(marker))
