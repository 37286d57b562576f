"""Line-first cleaning: rules judge lines, then what is left judges the text.

Each line of a text is held against three rules in turn:

- punctuation: running text has sentence ends, in any script's marks.  A line
  without one, a line with more loose symbols or exclamation marks than half
  its words, and a line nearly all in capitals fail.  Lines mostly in scripts
  that mark no sentence ends, and list items of four words or more that are
  mostly letters, need none.
- navigation: a line cut up by menu separators fails.
- boilerplate: a short line holding a stock phrase of web pages fails.

Failing lines are taken out.  A text that loses more than ``max_loss`` of its
words is rejected as a whole.

Texts are read whole, whatever their length; a very long one takes its
task memory in proportion.  Nulls and empty texts have no lines and no words, and fail the base rule on
length.  Repeated rows are judged each for itself, an empty table gives an
empty result, and any further columns of the input are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from trawl.llm.batches import filled, narrowed, per_text

# Stock phrases of page furniture, lower case.
BOILERPLATE = (
    "all rights reserved", "accept cookies", "click here", "cookie policy", "enable javascript",
    "log in to", "powered by", "privacy policy", "sign up for", "subscribe to our", "terms of service",
    "terms of use",
)
#: Marks that end a sentence by their Unicode property, and three that may.
TERMINALS = "".join(regex.findall(r"\p{Sentence_Terminal}", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x20000)])))) + "…:;：；"
SENTENCE_END = re.compile(rf"[{re.escape(TERMINALS)}][\"'”’»)\]*」』）]*(?:\s|$)")
#: Scripts written without marks at sentence ends.
UNMARKED = regex.compile(r"[\p{Thai}\p{Lao}\p{Tibetan}\p{Khmer}\p{Myanmar}\p{Javanese}]")
LIST_ITEM = re.compile(r"\s*(?:[-*•‣◦–]|\d{1,3}[.)]|[A-Za-z][.)])\s+\S")
ITEM_WORDS = 4
#: Menu separators beyond ASCII.
FURTHER_SEPARATORS = "·»›•→"
SYMBOLS = b"#*$%&|<>"
SEPARATORS = b"|>"
#: A line with this many words or fewer may be boilerplate.
BOILERPLATE_WORDS = 25
MIN_WORDS = 50
MAX_REPEATED = 50
MAX_LOSS = 0.5

SCHEMA = (
    "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, n_removed_lines long, n_removed_words long, "
    "removed array<struct<start: int, stop: int, rule: string>>, cleaned string"
)
SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("rule", pa.string())]))


def _symbols(raw: bytes, which: bytes) -> int:
    return len(raw) - len(raw.translate(None, which))


def _needs_no_end(line: str, words: int) -> bool:
    letters = sum(map(str.isalpha, line))
    if not line.isascii() and 2 * len(UNMARKED.findall(line)) > letters > 0:
        return True
    return words >= ITEM_WORDS and LIST_ITEM.match(line) is not None and 2 * letters > len(line)


def failing_rule(line: str) -> str | None:
    """The first rule that ``line`` breaks; lines without a word break none."""
    raw = line.encode()
    words = len(raw.split())
    if not words:
        return None
    separators = _symbols(raw, SEPARATORS)
    if not line.isascii():
        # one at the beginning marks a list item
        separators += sum(line.count(c, 1) for c in FURTHER_SEPARATORS)
    if 2 * _symbols(raw, SYMBOLS + b"!") > words and words > 1 or not (SENTENCE_END.search(line) or _needs_no_end(line, words)):
        return "navigation" if 5 * separators >= words else "punctuation"
    if 5 * separators >= words:
        return "navigation"
    if words >= 5 and line.upper() == line and line.lower() != line:
        return "punctuation"
    if words <= BOILERPLATE_WORDS:
        low = line.lower()
        if any(phrase in low for phrase in BOILERPLATE):
            return "boilerplate"
    return None


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    count = len(words) - 2
    if count < 2:
        return 0
    number: dict[bytes, int] = {}
    code = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    _, pair = np.unique(code[:-1] * len(number) + code[1:], return_inverse=True)
    _, window, times = np.unique(pair[:-1] * np.int64(len(number)) + code[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + count] |= again
    return int(covered.sum())


def judge(text: str, max_loss: float = MAX_LOSS) -> tuple:
    """All columns of one text, in the order of SCHEMA without the id."""
    raw = text.encode()
    words = raw.split()
    n_words = len(words)
    blanks = len(raw) - len(raw.translate(None, b" \t\n\r\x0b\x0c"))
    seen: set[str] = set()
    twice = removed_words = n_lines = start = 0
    kept_lines, removed = [], []
    for line in text.split("\n"):
        in_line = len(line.encode().split())
        rule = None
        if in_line:
            n_lines += 1
            twice += line in seen
            seen.add(line)
            rule = failing_rule(line)
        if rule:
            removed.append({"start": start, "stop": start + len(line), "rule": rule})
            removed_words += in_line
        else:
            kept_lines.append(line)
        start += len(line) + 1
    repeats = repeated_words(words)
    failed = n_words < MIN_WORDS or 100 * repeats > MAX_REPEATED * n_words
    kept = not failed and removed_words <= max_loss * n_words
    return (
        n_words, len(text) - blanks, _symbols(raw, SYMBOLS), twice, repeats, failed, kept,
        n_lines, len(removed), removed_words, removed, "\n".join(kept_lines),
    )


def clean_lines(rows: DataFrame, id_column: str = "doc_id", text_column: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """One row per input row: base figures, verdict, removed spans (code points) and the cleaned text."""
    names = [f.split()[0] for f in re.sub(r"<.*?>+", "", SCHEMA).split(", ")]

    def work(batch: pa.RecordBatch) -> dict:
        columns = list(zip(*(judge(t, max_loss) for t in filled(batch.column("text")))))
        out = {"id": batch.column("id")} | dict(zip(names[1:], map(list, columns)))
        out["removed"] = pa.array(out["removed"], SPANS)
        return out

    return per_text(narrowed(rows, id_column, text_column), work, SCHEMA)
