"""One form for texts that look the same, by DuckDB inside Arrow partitions.

All rules are one nested SQL query, built below from tables of fixed values: line breaks and spaces to
one kind each, invisible characters away, compatibility forms (widths, fonts, joined letters) to plain
ones, look-alike letters of other scripts to Latin, and composed accents (NFC). Case, digits, the number of spaces and
everything else that can be seen stay.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorloom.functions.common import cut_lineage

# Letters of other scripts and the Latin letters that look the same.
CYRILLIC = ("аеорсухѕіјһԁԛԝӏүѵԍАВЕКМНОРСТУХЅІЈԚԜӀҮѴԌ", "aeopcyxsijhdqwlyvGABEKMHOPCTYXSIJQWIYVG")
GREEK = ("ονρΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ovpABEZHIKMNOPTYX")
ARMENIAN = ("օհսՕ", "ohuO")
CHEROKEE = ("ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᏔᏃ", "ABCDEGHJKLMPRSTVWZ")
LISU = ("ꓮꓐꓚꓓꓰꓝꓖꓧꓲꓙꓗꓡꓟꓠꓳꓑꓣꓢꓔꓴꓦꓪꓫꓬꓜ", "ABCDEFGHIJKLMNOPRSTUVWXYZ")
LATIN = ("ɑɡ", "ag")
LOOK_ALIKES = [CYRILLIC, GREEK, ARMENIAN, CHEROKEE, LISU, LATIN]
# Characters that are not seen, as a class of DuckDB's regular expressions.
INVISIBLE = (
    r"[\x00-\x08\x0e-\x1f\x7f-\x84\x86-\x9f\x{ad}\x{34f}\x{61c}\x{115f}\x{1160}\x{17b4}\x{17b5}\x{180b}-\x{180f}\x{200b}-\x{200f}\x{202a}-\x{202e}"
    r"\x{2060}-\x{206f}\x{fe00}-\x{fe0f}\x{feff}\x{fff9}-\x{fffb}\x{e0000}-\x{e01ef}]+"
)
# Line breaks, and spaces of any width.
BREAKS = r"\r\n|[\r\x0b\x0c\x{85}\x{2028}\x{2029}]"
SPACES = "\t               　"
# Hyphens that look like the ASCII one.
HYPHENS = "‐‑"
# Compatibility forms that look like what they stand for: other widths, fonts and positions. Those
# that can be told from it (superscripts, circled and fractional ones) stay.
SAME_LOOK = ("<wide>", "<narrow>", "<font>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>")
# Ranges of joined letters, Roman numerals and squared units.
JOINED = [(0x132, 0x133), (0x1C4, 0x1CC), (0x1F1, 0x1F3), (0x2160, 0x217F), (0x3371, 0x33DF), (0xFB00, 0xFB06)]


@cache
def _compatibility() -> tuple[dict[str, str], dict[str, str]]:
    """The compatibility forms of one plain character, and those of several."""
    one, several = {}, {}
    joined = {chr(c) for a, b in JOINED for c in range(a, b + 1)}
    for c in map(chr, [*range(0xA0, 0xD800), *range(0xF900, 0x20000)]):
        tag = unicodedata.decomposition(c).split(" ")[0]
        plain = unicodedata.normalize("NFKC", c)
        if plain == c or c in SPACES or not (tag in SAME_LOOK or (c in joined and plain.isascii() and plain.isalpha())):
            continue
        if len(plain) == 1:
            one[c] = plain
        elif c in joined:
            several[c] = plain
    return one, several


def _translations() -> list[dict[str, str]]:
    """The characters that become one other character each: the common ones, and the compatibility forms."""
    look = {a: b for x in LOOK_ALIKES for a, b in zip(*x)}
    common = dict.fromkeys(SPACES, " ") | dict.fromkeys(HYPHENS, "-") | look
    for c in map(chr, range(0x370, 0x530)):  # accented letters whose base looks Latin
        base, *marks = unicodedata.normalize("NFD", c)
        if marks and base in look:
            whole = unicodedata.normalize("NFC", look[base] + "".join(marks))
            if len(whole) == 1:
                common[c] = whole
    return [common, {c: look.get(plain, plain) for c, plain in _compatibility()[0].items() if c not in common}]


def _class(chars: Iterable[str]) -> str:
    """A class of DuckDB's regular expressions of the characters, neighbours as ranges."""
    codes = sorted(map(ord, chars))
    starts = [c for i, c in enumerate(codes) if not i or codes[i - 1] != c - 1]
    ends = [c for i, c in enumerate(codes) if i + 1 == len(codes) or codes[i + 1] != c + 1]
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(starts, ends)) + "]"


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@cache
def canonical_from(source: str, column: str) -> str:
    """A DuckDB subquery: the rows of source, with column in its canonical form.

    Each step runs only over the texts that hold a character of its kind, as few do.
    """
    several = _compatibility()[1]
    joined = column
    for c, letters in several.items():
        joined = f"replace({joined}, {_quoted(c)}, {_quoted(letters)})"
    steps = [
        (BREAKS, f"regexp_replace({column}, '{BREAKS}', chr(10), 'g')"),
        (INVISIBLE, f"regexp_replace({column}, '{INVISIBLE}', '', 'g')"),
        (_class(several), joined),
        *((_class(t), f"translate({column}, {_quoted(''.join(t))}, {_quoted(''.join(t.values()))})") for t in _translations()),
        (r"[^\x00-\x{2ff}]", f"nfc_normalize({column})"),  # accents to be joined begin there
    ]
    for seen, made in steps:
        source = f"(SELECT * REPLACE (CASE WHEN regexp_matches({column}, '{seen}') THEN {made} ELSE {column} END AS {column}) FROM {source})"
    return source


_connection = None


def run_sql(batch: pa.RecordBatch | pa.Table, sql: str) -> pa.Table:
    """The result of sql over the Arrow data, which it calls batch."""
    global _connection
    if _connection is None:
        _connection = duckdb.connect(config={"threads": 1, "memory_limit": "512MB"})
    _connection.register("batch", pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch)
    try:
        return _connection.sql(sql).to_arrow_table()
    finally:
        _connection.unregister("batch")


def _map_sql(sql: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from run_sql(b, sql).to_batches()

    return run


def canonical_text(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, canonical): each document's text in the form in which texts that look the same are equal.

    A null text stays null, a text of invisible characters only becomes empty. Other columns of df
    are not carried; repeated rows come out as often as they come in.
    """
    d = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return d.mapInArrow(_map_sql(f"SELECT doc_id, text AS canonical FROM {canonical_from('batch', 'text')}"), "doc_id long, canonical string")


def _digests(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, stored, look): digests of the text as stored and of its canonical form; only texts with something to see."""
    d = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).filter("doc_id is not null and text is not null")
    source = canonical_from("(SELECT doc_id, text AS raw, text FROM batch)", "text")
    sql = f"SELECT doc_id, unhex(sha256(raw)) AS stored, unhex(sha256(text)) AS look FROM {source} WHERE regexp_matches(text, '[^\\s]')"
    return d.mapInArrow(_map_sql(sql), "doc_id long, stored binary, look binary")


def look_alike_classes(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, variants, links): each document with the smallest doc_id that looks like it.

    variants is the number of different stored texts in the class, links that of its documents with
    another stored text. Exact copies share a class. Documents without a visible character or without
    id take no part; repeated rows count once.
    """
    d = cut_lineage(_digests(df, doc_id, text).distinct())
    texts = d.groupBy("look", "stored").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    classes = texts.groupBy("look").agg(F.min("first").alias("class_id"), F.count("*").alias("variants"), F.sum("n").alias("all"))
    own = texts.join(classes, "look").select("look", "stored", "class_id", "variants", (F.col("all") - F.col("n")).alias("links"))
    return d.join(own, ["look", "stored"]).select("doc_id", "class_id", "variants", "links")


def look_alike_pairs(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text", every_pair: bool = False, piece_rows: int = 100) -> DataFrame:
    """(doc_id_a, doc_id_b), the smaller first: documents that look the same but differ as stored.

    Each stored text stands for its copies by its first document, and is linked to the first document of
    its class: as many rows as there are texts; look_alike_classes gives the membership of all documents.
    With every_pair all pairs of documents come out. Then texts of one look, and after them the copies of
    two texts, are hashed into pieces of about piece_rows, and every two pieces meet in a task of their
    own, so that neither a look nor a text gathers anywhere.
    Documents without text, id or visible character take no part.
    """
    d = cut_lineage(_digests(df, doc_id, text).distinct())  # each text is read once
    texts = d.groupBy("look", "stored").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    classes = texts.groupBy("look").agg(F.count("*").alias("variants"), F.min("first").alias("class_id")).filter("variants > 1")
    texts = texts.join(classes, "look")
    if not every_pair:
        return texts.filter("first <> class_id").select(F.col("class_id").alias("doc_id_a"), F.col("first").alias("doc_id_b"))
    pieces = lambda n: F.ceil(F.col(n) / piece_rows).cast("long")

    def cut(df: DataFrame, by: str, own: str, other: str) -> DataFrame:
        """df with its piece i_own out of k_own, once for every piece i_other of the other side."""
        df = df.withColumn(f"i_{own}", F.pmod(F.xxhash64(by), F.col(f"k_{own}")))
        return df.withColumn(f"i_{other}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"k_{other}") - 1)))

    side = lambda s: texts.select("look", F.col("stored").alias(f"stored_{s}"), F.col("n").alias(f"n_{s}"), pieces("variants").alias("k_a"), pieces("variants").alias("k_b"))
    a, b = cut(side("a"), "stored_a", "a", "b").drop("k_a", "k_b"), cut(side("b"), "stored_b", "b", "a").drop("k_a", "k_b")
    links = a.join(b, ["look", "i_a", "i_b"]).filter("stored_a < stored_b").select("look", "stored_a", "stored_b", pieces("n_a").alias("k_a"), pieces("n_b").alias("k_b"))

    def copies(s: str, o: str) -> DataFrame:
        docs = d.select("look", F.col("stored").alias(f"stored_{s}"), F.col("doc_id").alias(f"doc_{s}"))
        return cut(links.join(docs, ["look", f"stored_{s}"]), f"doc_{s}", s, o).drop("k_a", "k_b")

    met = copies("a", "b").join(copies("b", "a"), ["look", "stored_a", "stored_b", "i_a", "i_b"])
    return _ordered(met.select(F.col("doc_a").alias("x"), F.col("doc_b").alias("y")))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b")).filter("doc_id_a < doc_id_b").distinct()
