"""Counts of a batch of texts that the rule operators share."""

from __future__ import annotations

import numpy as np

from . import common as C

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[33, 34, 39, 40, 41, 44, 46, 58, 59, 63]] = True
_SHOUT = np.zeros(256, bool)
_SHOUT[33] = True


def _sums(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offs[1:]] - total[offs[:-1]]


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key occurs twice or more; whether it is the first of its kind."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.ones(len(k), bool)
    first[1:] = k[1:] != k[:-1]
    last = np.ones(len(k), bool)
    last[:-1] = first[1:]
    many, head = np.empty(len(k), bool), np.empty(len(k), bool)
    many[order], head[order] = ~(first & last), first
    return many, head


def _keyed(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return C.mix(values + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def rule_counts(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines
    with a word that equal an earlier line), n_repeat_words (words in 3-word
    windows found twice or more in the text), and n_lines with a word."""
    starts, ends, first = C.word_bounds(buf, offs)
    n_docs = len(offs) - 1
    out = {"n_words": np.diff(first)}
    out["word_chars"] = _sums(~C.SEPARATORS[buf] & ((buf & 0xC0) != 0x80), offs)
    out["n_symbols"] = _sums(_SYMBOL[buf], offs)

    doc = np.repeat(np.arange(n_docs), np.diff(first))
    words = C.span_hashes(buf, starts, ends)
    inside = np.flatnonzero(C.runs_within(first, 3))
    covered = np.zeros(len(words) + 1, np.int64)
    if len(inside):
        many, _ = _repeats(_keyed(C.gram_hashes(words, 3)[inside], doc[inside]))
        hit = inside[many]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + 3, -1)
    out["n_repeat_words"] = _sums(np.cumsum(covered[:-1]) > 0, first)

    a, z, line_first = C.word_bounds(buf, offs, _NEWLINE)
    has_word = np.searchsorted(starts, z) > np.searchsorted(starts, a)
    line_doc = np.repeat(np.arange(n_docs), np.diff(line_first))[has_word]
    _, head = _repeats(_keyed(C.span_hashes(buf, a[has_word], z[has_word]), line_doc))
    out["n_lines"] = np.bincount(line_doc, minlength=n_docs)
    out["n_dup_lines"] = np.bincount(line_doc[~head], minlength=n_docs)
    out["n_distinct_words"] = np.bincount(doc[_repeats(_keyed(words, doc))[1]], minlength=n_docs) if len(words) else np.zeros(n_docs, np.int64)
    return out


#: What quality_features gives for each text, in this order.
FEATURES = ("n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "digit_share", "punct_share", "pipe_share", "shout_share", "line_words", "wide_share")


def quality_features(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """Shares and lengths by the names in FEATURES; 0 where the base is 0."""
    c = rule_counts(buf, offs)
    share = lambda x, base: np.where(base > 0, x / np.maximum(base, 1), 0.0)
    n, chars = c["n_words"], c["word_chars"]
    pipe = np.zeros(256, bool)
    pipe[124] = True
    letters = _sums(_UPPER[buf] | _LOWER[buf], offs)
    return {
        "n_words": n.astype(float),
        "word_length": share(chars, n),
        "symbol_share": share(c["n_symbols"], n),
        "dup_line_share": share(c["n_dup_lines"], c["n_lines"]),
        "repeat_share": share(c["n_repeat_words"], n),
        "distinct_share": share(c["n_distinct_words"], n),
        "upper_share": share(_sums(_UPPER[buf], offs), letters),
        "digit_share": share(_sums(_DIGIT[buf], offs), chars),
        "punct_share": share(_sums(_PUNCT[buf], offs), n),
        "pipe_share": share(_sums(pipe[buf], offs), n),
        "shout_share": share(_sums(_SHOUT[buf], offs), n),
        "line_words": share(n, c["n_lines"]),
        "wide_share": share(_sums((buf > 191), offs), chars),
    }
