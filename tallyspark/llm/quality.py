"""Line-first quality rules: lines that fail go, then documents that lost too much text.

A line (a \\n-separated part with a word) fails if
- symbols: at least a tenth of its word characters are #*$%&|<>
- punctuation: it has at least three ! and more than one per three words, or it has ten words or more
  and ends in a letter, digit or comma of ASCII
- navigation: at least three of its words, and a quarter of them, are one of `SEPARATORS`
- repetition: it has five words or more, and more than half equal the word before them in the line
- boilerplate: at most 40 words, with a phrase of `BOILERPLATE`
- duplicate: it equals an earlier line of the document.
A document is rejected if it fails the base rules (under 50 words, or more than half of its words in
repeated three-word windows) or if more than half of its words are in failed lines.

The work is one pass of array operations over the bytes of about a megabyte of texts at a time, so no
text moves between tasks and a hot source does not matter. Lines and words are compared by 64-bit
hashes within one document. Null and empty texts have no words and are rejected; repeated rows and
missing ids are judged row by row; one very long text is handled alone in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyspark.llm.textbytes import CODES, LOWER, WHITE, Hasher, Texts, grams, mix, spans_of, table, texts_of

MIN_WORDS = 50
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Words that part the entries of a menu.
SEPARATORS = ("|", ">", "»", "›", "·", "•")
#: English, German, French and Spanish phrases of page furniture; only A-Z match in either case.
BOILERPLATE = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "cookies to",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "privacy policy",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "alle rechte vorbehalten",
    "cookie-richtlinie",
    "hier klicken",
    "javascript aktivieren",
    "newsletter abonnieren",
    "nutzungsbedingungen",
    "zum inhalt springen",
    "activer javascript",
    "aller au contenu",
    "cliquez ici",
    "conditions d'utilisation",
    "politique de confidentialité",
    "tous droits réservés",
    "activar javascript",
    "aviso legal",
    "haga clic aquí",
    "política de privacidad",
    "términos de uso",
    "todos los derechos reservados",
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words")
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean"

_IS_SYMBOL = table(SYMBOLS)
_OPEN_END = table("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789,")
_PHRASES = tuple(p.encode() for p in BOILERPLATE)


def _before(flags: np.ndarray) -> np.ndarray:
    """Running counts: out[i] is the sum of flags[:i]."""
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _again(keys: np.ndarray) -> np.ndarray:
    """Which keys stand earlier in the array as well."""
    _, first = np.unique(keys, return_index=True)
    flags = np.ones(len(keys), bool)
    flags[first] = False
    return flags


def _one_of(words: tuple[str, ...], data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of the byte ranges hold one of a few short words."""
    flags = np.zeros(len(starts), bool)
    for word in words:
        code = word.encode()
        at = np.flatnonzero(ends - starts == len(code))
        for k, byte in enumerate(code):
            at = at[data[starts[at] + k] == byte]
        flags[at] = True
    return flags


def judge(texts: Texts, hasher: Hasher) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Counts and verdicts of each text, and for each byte whether it belongs to a failed line."""
    data, offsets = texts.data, texts.offsets
    count = len(offsets) - 1
    white = WHITE[data]
    starts, ends, words_at = spans_of(~white, offsets)
    words = hasher.ranges(data, starts, ends, CODES)
    text_of_word = np.repeat(np.arange(count), np.diff(words_at))

    lead = _before(((data & 0xC0) != 0x80) & ~white)  # code points inside words
    symbols = _before(_IS_SYMBOL[data])
    loud = _before(data == ord("!"))
    bars = _before(_one_of(SEPARATORS, data, starts, ends))

    # Words in three-word windows that occur again in the same text.
    triples = grams(words, 3)
    if len(triples):
        triples = mix(triples + text_of_word[:-2].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        valid = text_of_word[:-2] == text_of_word[2:]
        _, kind, often = np.unique(triples[valid], return_inverse=True, return_counts=True)
        places = np.flatnonzero(valid)[often[kind] > 1]
    else:
        places = np.zeros(0, np.int64)
    repeated = np.zeros(len(words) + 2, bool)
    for k in range(3):
        repeated[places + k] = True
    repeated = _before(repeated[: len(words)])

    low, high, lines_at = spans_of(data != ord("\n"), offsets)
    first, last = np.searchsorted(starts, low), np.searchsorted(starts, high)
    n = last - first
    worded = n > 0
    text_of_line = np.repeat(np.arange(count), np.diff(lines_at))
    keys = hasher.ranges(data, low, high, CODES)
    keys = mix(keys + text_of_line.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    copied = np.zeros(len(low), bool)
    copied[worded] = _again(keys[worded])

    follows = np.zeros(len(words), bool)
    follows[1:] = words[1:] == words[:-1]
    line_start = np.zeros(len(words) + 1, bool)
    line_start[first] = True
    follows &= ~line_start[: len(words)]
    follows = _before(follows)

    def of_lines(running: np.ndarray, by_word: bool = False) -> np.ndarray:
        return running[last] - running[first] if by_word else running[high] - running[low]

    phrases = np.zeros(len(low), bool)
    if len(low):
        folded = LOWER[data].tobytes()
        for phrase in _PHRASES:
            at = folded.find(phrase)
            while at >= 0:
                line = int(np.searchsorted(low, at, side="right")) - 1
                if line >= 0 and at + len(phrase) <= high[line]:
                    phrases[line] = True
                at = folded.find(phrase, at + 1)
    tail = np.zeros(len(low), np.uint8)
    tail[worded] = data[ends[last[worded] - 1] - 1]
    exclaims, pipes = of_lines(loud), of_lines(bars, by_word=True)
    failed = worded & (
        (10 * of_lines(symbols) >= of_lines(lead))
        | ((exclaims >= 3) & (3 * exclaims > n))
        | ((n >= 10) & _OPEN_END[tail])
        | ((pipes >= 3) & (4 * pipes >= n))
        | ((n >= 5) & (2 * of_lines(follows, by_word=True) > n))
        | (phrases & (n <= 40))
        | copied
    )

    def of_texts(running: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(running[at])

    out = {
        "n_words": np.diff(words_at),
        "word_chars": of_texts(lead, offsets),
        "n_symbols": of_texts(symbols, offsets),
        "n_dup_lines": of_texts(_before(copied), lines_at),
        "n_repeat_words": of_texts(repeated, words_at),
        "n_lost_words": of_texts(_before(np.where(failed, n, 0)), lines_at),
    }
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
    out["kept"] = ~out["base_failed"] & (2 * out["n_lost_words"] <= out["n_words"])
    gone = np.zeros(len(data) + 1, np.int64)
    np.add.at(gone, low[failed], 1)
    np.add.at(gone, np.minimum(high[failed] + 1, offsets[text_of_line[failed] + 1]), -1)  # with its line break
    return out, np.cumsum(gone[:-1]) > 0


def score(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every row. Other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for texts in texts_of(batch):
                out, _ = judge(texts, hasher)
                ids = batch.column("doc_id")[texts.first : texts.last].cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, out.values())], ["doc_id", *out])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def clean(docs: DataFrame) -> DataFrame:
    """The documents that are kept, their texts without failed lines; all columns stay."""
    names = docs.columns
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for texts in texts_of(batch):
                out, gone = judge(texts, hasher)
                kept = np.flatnonzero(out["kept"])
                if not len(kept):
                    continue
                rest = [texts.data[a:b][~gone[a:b]].tobytes() for a, b in zip(texts.offsets[kept], texts.offsets[kept + 1], strict=True)]
                rows = pa.RecordBatch.from_arrays(batch.columns, names=names).take(pa.array(kept + texts.first))
                columns = rows.columns
                columns[at] = pa.array(rest, pa.binary()).cast(batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema)
