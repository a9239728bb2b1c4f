"""Personal data: base patterns, and a linear-chain conditional random field.

The field reads tokens (runs without blanks) by their word shape, that of
their neighbours and a few cue words, and tags them B-/I- of a kind or O. It is
trained from a small labelled table and decoded by Viterbi over numpy batches.
It adds spans that the patterns miss (national phone numbers, cards with a
wrong check digit, bracketed addresses); pattern spans always stay.

Only tokens within a few places of a digit, an @ or a bracketed "at" can begin
or end a span, so the field is decoded over those neighbourhoods, wherever in the text they are.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common as C

#: Kinds in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])
BITS = 12
REACH = 3

# Possessive forms match what plain ones do (each run is read once), in time
# proportional to the text.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?+")
_IP = re.compile(r"([0-9]++)(?:\.([0-9]++)\.([0-9]++)\.([0-9]++))?+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
#: What a token must have for a span to begin or end near it.
_SEED = re.compile(r"[0-9@]|[(\[]at[)\]]")
_TRIGGER = np.zeros(256, bool)
_TRIGGER[48:58] = _TRIGGER[64] = True

#: The labelled table: texts with spans written as <kind:text>. Names, hosts
#: and numbers are invented.
LABELLED = (
    "write to <email:ann.lee@mail.example.org> for the minutes",
    "Contact <email:b_ortiz@host.example>, please",
    "mail <email:kim(at)post.example> or wait until 2019",
    "reach me via <email:j.doe[at]corp.example.net>.",
    "sent from <email:x9@localhost> at 10:45",
    "their address is <email:sales@shop> today",
    "server <ip:10.0.12.7> restarted 3 times",
    "ping <ip:192.168.1.20>:8080 failed",
    "host at <ip:172.16.0.9>, port 443",
    "version 2.4.1 of the tool and 1.0.0.1.2 were out",
    "see section 3.2.1 and table 4.5",
    "card <card:4111 1111 1111 1111> expires 09/27",
    "paid with <card:5500-0000-0000-0004> on 12 May",
    "the number <card:4362971821055608> was declined",
    "and <card:9362971821055601> followed by words",
    "<card:3714655751500280> there it was again",
    "words then <card:6011000990139425> and more words",
    "card no. <card:3782 822463 10005> was lost",
    "order 4362971 shipped in 2021",
    "call <phone:+1 (640) 555-0123> after six",
    "phone <phone:(212) 555-0187> today",
    "ring <phone:555-0142> or <phone:020 7946 0958>",
    "tel. <phone:+44 20 7946 0991> office",
    "fax: <phone:(415) 555-0110>",
    "mobile <phone:07700 900123> for Mia",
    "call <phone:415-555-0199> now",
    "the phone <phone:1-800-555-0100> is free",
    'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" stays',
    'token = "8b99b6f89edc9746a2ef7e89e21f68bcb4543dff" here',
    'key = "ede43f42c939b6405768150e0411590525cf889e" and text',
    "TOKEN = \"0AA93D86C7F5B09FE5949719B6B82BC439E93300\"!! THE!!",
    "between 1998 and 2004 sales rose 35%%%",
    "a score of 12 to 9 in 90 minutes",
    "price 1,299.00 or 1299 euro",
    "at 14:30 on 2023-05-17 we met",
    "call 3 friends and ring the bell twice",
    "the card has 16 digits and 4 groups",
    "chapter 12 verse 7 page 338",
    "room 404 on floor 5 of building 21",
    "id 123456 and ref 99812",
    "rated 4.5 of 5 by 1200 people",
    "there was nothing here to see at all",
    "the phone was lost and the card was found",
    "see https://www.example.org/a/b?id=42 for it",
    "isbn 978-3-16-148410-0 is a book",
    "@home we say hello @ noon",
    "follow @somebody for more",
    "x = 0.123456789 + 17",
    "lot 20231105123456 is ready",
    "Copyright 2014-2020 the authors",
)

_CUES = {w: i for i, w in enumerate("card visa number no. no call phone tel tel. fax fax: mobile ring mail email e-mail contact write ip host server ping token key id order version at via =".split())}


def labelled_table(spark: SparkSession) -> DataFrame:
    """The small labelled table as a DataFrame with the column `marked`."""
    return spark.createDataFrame([(m,) for m in LABELLED], "marked string")


def read_marked(marked: str) -> tuple[str, list[tuple[str, int, int]]]:
    """Text and spans of a text with <kind:...> marks."""
    text, spans, at = "", [], 0
    for m in re.finditer(r"<(email|ip|card|phone):([^>]*)>", marked):
        text += marked[at : m.start()]
        spans.append((m[1], len(text), len(text) + len(m[2])))
        text += m[2]
        at = m.end()
    return text + marked[at:], spans


# ---------------------------------------------------------------- patterns
def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) << (i & 1)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by start, then kind as listed."""
    out = []
    if "@" in text:
        out += [("email", m.start(), m.end()) for m in _EMAIL.finditer(text) if m[1]]
    for m in _IP.finditer(text):
        if m[2] and all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups()):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# ---------------------------------------------------------------- the field
@dataclass
class Field:
    """Weights of hashed features for each tag, and of tag transitions; `start`
    and `end` are those of the first and the last tag."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray
    end: np.ndarray


def _shape(token: str) -> str:
    """Letters as a, digits as 9, runs shortened to their length class."""
    s = re.sub(r"[^\W\d_]", "a", token)
    s = re.sub(r"[0-9]", "9", s)
    return re.sub(r"(a+|9+)", lambda m: m[0][0] + (str(len(m[0])) if m[0][0] == "9" and len(m[0]) < 6 else "n" if m[0][0] == "9" and len(m[0]) < 13 else "c" if m[0][0] == "9" and len(m[0]) < 20 else "" if m[0][0] == "a" else "z"), s)


def _feature_ids(tokens: list[str]) -> list[list[int]]:
    """Hashed features of each token of a neighbourhood."""
    shapes = [_shape(t) for t in tokens]
    cues = [t.lower() if t.lower() in _CUES else "" for t in tokens]
    out = []
    for i, t in enumerate(tokens):
        own = shapes[i]
        digits = sum(c.isdigit() for c in t)
        f = ["bias", f"s={own}", f"n={min(digits, 20)}", f"at={'@' in t}", f"alpha={digits == 0}", f"mix={digits > 0 and 'a' in own}", f"dots={min(t.count('.'), 5)}", f"first={t[0] if not t[0].isalnum() else ''}"]
        for d in (-2, -1, 1):
            j = i + d
            f.append(f"s{d}={shapes[j] if 0 <= j < len(tokens) and any(c in '9@' for c in shapes[j]) else '-'}")
            f.append(f"c{d}={cues[j] if 0 <= j < len(tokens) else ''}")
        f.append(f"s-1s={f[-6]}|{own}")
        out.append([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=4).digest(), "little") & ((1 << BITS) - 1) for x in f])
    return out


def _tags(tokens: list[tuple[int, int]], spans: list[tuple[str, int, int]]) -> list[int]:
    out = []
    for a, z in tokens:
        tag = 0
        for kind, s, e in spans:
            if a < e and s < z:
                tag = 1 + 2 * KINDS.index(kind) + (a > s)
        out.append(tag)
    return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def fit(marked: list[str], rounds: int = 60, rate: float = 0.2, decay: float = 1e-3) -> Field:
    """Maximum likelihood with an L2 penalty, by Adagrad over the sentences;
    gradients from forward and backward sums."""
    data = []
    for m in marked:
        text, spans = read_marked(m)
        at = [t.span() for t in _TOKEN.finditer(text)]
        if at:
            data.append((np.array(_feature_ids([text[a:z] for a, z in at])), np.array(_tags(at, spans))))
    n = len(TAGS)
    w = Field(np.zeros((1 << BITS, n)), np.zeros((n, n)), np.zeros(n), np.zeros(n))
    seen = Field(*(np.full(x.shape, 1e-2) for x in (w.emit, w.move, w.start, w.end)))
    rng = np.random.default_rng(11)
    for _ in range(rounds):
        for i in rng.permutation(len(data)):
            ids, y = data[i]
            e = w.emit[ids].sum(1)
            steps = len(e)
            fwd, bwd = np.zeros((steps, n)), np.zeros((steps, n))
            fwd[0] = w.start + e[0]
            for t in range(1, steps):
                fwd[t] = _logsum(fwd[t - 1][:, None] + w.move, 0) + e[t]
            bwd[-1] = w.end
            for t in range(steps - 2, -1, -1):
                bwd[t] = _logsum(w.move + (e[t + 1] + bwd[t + 1])[None], 1)
            z = _logsum(fwd[-1] + w.end, 0)
            node = np.exp(fwd + bwd - z)
            node[np.arange(steps), y] -= 1
            edge = np.zeros((n, n))
            for t in range(1, steps):
                edge += np.exp(fwd[t - 1][:, None] + w.move + (e[t] + bwd[t])[None] - z)
            np.add.at(edge, (y[:-1], y[1:]), -1)
            first, last = node[0], np.exp(fwd[-1] + w.end - z)
            last[y[-1]] -= 1
            grad = np.zeros((len(np.unique(ids)), n))
            at, inv = np.unique(ids, return_inverse=True)
            np.add.at(grad, inv.reshape(ids.shape), node[:, None, :])
            for x, s, g, k in ((w.emit, seen.emit, grad, at), (w.move, seen.move, edge, slice(None)), (w.start, seen.start, first, slice(None)), (w.end, seen.end, last, slice(None))):
                g = g + decay * x[k]
                s[k] += g * g
                x[k] -= rate * g / np.sqrt(s[k])
    # a B or O never leads into I of another kind, nor does a text begin with I
    for t in range(2, n, 2):
        w.start[t] = -1e6
        w.move[[a for a in range(n) if a not in (t - 1, t)], t] = -1e6
    return w


def viterbi(field: Field, emit: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Best tags of a batch: emit (batch, steps, tags), size tokens in each."""
    batch, steps, n = emit.shape
    best = field.start + emit[:, 0]
    back = np.zeros((batch, steps, n), np.int8)
    for t in range(1, steps):
        via = best[:, :, None] + field.move[None]
        back[:, t] = via.argmax(1)
        new = via.max(1) + emit[:, t]
        best = np.where((t < size)[:, None], new, best)
    tags = np.zeros((batch, steps), np.int8)
    now = (best + field.end).argmax(1)
    for t in range(steps - 1, -1, -1):
        live = t < size
        tags[live, t] = now[live]
        now = np.where(live & (t > 0), back[np.arange(batch), t, now], now)
    return tags


def _neighbourhoods(text: str) -> list[list[tuple[int, int]]]:
    """Token spans around tokens with a digit, an @ or a bracketed at, runs joined."""
    at = [m.span() for m in _TOKEN.finditer(text)]
    hot = [i for i, (a, z) in enumerate(at) if _SEED.search(text[a:z])]
    out: list[list[int]] = []
    for i in hot:
        lo, hi = max(0, i - REACH), min(len(at), i + REACH + 1)
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    return [at[lo:hi] for lo, hi in out]


_TRIM = " \t\n\r\x0b\x0c.,;:!?\"'<>*#$%&|="


def find_spans(texts: list[str], field: Field, batch: int = 256) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    work = [(i, span) for i, t in enumerate(texts) for span in _neighbourhoods(t)]
    added: list[list] = [[] for _ in texts]
    work.sort(key=lambda w: len(w[1]))
    for lo in range(0, len(work), batch):
        part = work[lo : lo + batch]
        size = np.array([len(s) for _, s in part])
        if size.max() * len(part) > 200_000:  # a few very long runs: one at a time
            groups = [[p] for p in part]
        else:
            groups = [part]
        for group in groups:
            size = np.array([len(s) for _, s in group])
            emit = np.zeros((len(group), size.max(), len(TAGS)))
            for j, (i, s) in enumerate(group):
                emit[j, : len(s)] = field.emit[np.array(_feature_ids([texts[i][a:z] for a, z in s]))].sum(1)
            tags = viterbi(field, emit, size)
            for j, (i, s) in enumerate(group):
                open_ = None
                for (a, z), tag in [*zip(s, tags[j]), ((0, 0), 0)]:
                    if open_ and (tag == 0 or tag % 2 == 1):
                        added[i].append(open_)
                        open_ = None
                    if tag:
                        open_ = (KINDS[(tag - 1) // 2], open_[1] if open_ else a, z)
    out = []
    for text, own, more in zip(texts, base, added):
        spans = list(own)
        for kind, a, z in more:
            piece = text[a:z]
            a, z = a + len(piece) - len(piece.lstrip(_TRIM)), z - (len(piece) - len(piece.rstrip(_TRIM)))
            if a < z and all(z <= s or e <= a for _, s, e in own):
                spans.append((kind, a, z))
        out.append((own, sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))))
    return out


def _triggered(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Whether each text may have a token that _SEED finds: by its bytes. A
    bracketed at that runs across two texts counts for the first (it costs time
    only)."""
    seed = _TRIGGER[buf]
    if len(buf) > 3:
        opens, closes = (buf == 40) | (buf == 91), (buf == 41) | (buf == 93)
        seed[:-3] |= opens[:-3] & (buf[1:-2] == 97) & (buf[2:-1] == 116) & closes[3:]
    total = np.concatenate([[0], np.cumsum(seed)])
    return total[offs[1:]] > total[offs[:-1]]


def _join(spans: list) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


def _each(batches, at: int, field: Field):
    """(batch slice, texts, spans of each) over the batches; texts without
    a seed have none."""
    for b in batches:
        for lo, hi, buf, offs in C.text_slices(b.column(at)):
            part = b.slice(lo, hi - lo)
            texts = part.column(at)
            found = [([], [])] * (hi - lo)
            rows = np.flatnonzero(_triggered(buf, offs))
            for i, spans in zip(rows, find_spans([texts[int(i)].as_py() for i in rows], field)):
                found[i] = spans
            yield part, texts, found


def _field(spark: SparkSession, examples: DataFrame | None):
    # a small labelled table, by contract: a few hundred rows
    rows = (labelled_table(spark) if examples is None else examples).select("marked").where("marked is not null").orderBy("marked").limit(5000).collect()
    return spark.sparkContext.broadcast(fit([r[0] for r in rows]))


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", examples: DataFrame | None = None) -> DataFrame:
    """Spans of every text.

    Returns id, n_email, n_ip, n_card, n_phone (of the base patterns), base and
    spans: kind:start:end of base spans and of all spans (code points, end
    exclusive) by start, then kind, comma-joined. examples: the labelled table
    (column `marked`, 5000 rows at most are read); by default the built-in one.
    A null text is empty. One row for each input row; repeated rows give equal
    rows and a null id stays null. Other columns play no part, whatever their
    names; an empty table gives an empty result. A text of any length is read
    whole by one task, which holds the features of its neighbourhoods at a time.
    """
    field = _field(docs.sparkSession, examples)
    counts = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    schema = T.StructType([docs.schema[id_col], *counts, T.StructField("base", T.StringType()), T.StructField("spans", T.StringType())])

    def run(batches):
        for part, _, found in _each(batches, 1, field.value):
            n = {f"n_{k}": [sum(s[0] == k for s in own) for own, _ in found] for k in KINDS}
            yield C.arrow_rows(schema, **{id_col: part.column(0)}, **n, base=[_join(own) for own, _ in found], spans=[_join(s) for _, s in found])

    return docs.select(id_col, text_col).mapInArrow(C.tidy(run), schema)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """text with every span (overlapping ones joined) replaced by <KIND>."""
    out, at = [], 0
    for kind, a, z in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, z)
    return "".join(out) + text[at:]


def redact_pii(docs: DataFrame, *, text_col: str = "text", examples: DataFrame | None = None) -> DataFrame:
    """docs with every span in its text replaced by its kind. Null texts stay
    null, repeated rows are treated alike, and all other columns pass through,
    whatever their names. An empty table stays empty; a text of any length is
    read whole by one task."""
    field = _field(docs.sparkSession, examples)
    schema, names, at = docs.schema, docs.columns, docs.columns.index(text_col)

    def run(batches):
        for part, texts, found in _each(batches, at, field.value):
            cols = {n: part.column(i) for i, n in enumerate(names)}
            if any(s for _, s in found):
                cols[text_col] = pa.array([redact(t.as_py(), s) if s else t.as_py() for t, (_, s) in zip(texts, found)], pa.string())
            yield C.arrow_rows(schema, **cols)

    return docs.mapInArrow(C.tidy(run), schema)


def op4_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = find_pii(docs)
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")
