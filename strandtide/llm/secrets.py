"""Secret scan: candidate strings, and a random forest that takes out the false positives.

Candidates are the values of settings named after secrets, credentials in URLs and words in quotes, all of
any length and signs, and elsewhere runs of letters, digits and a few signs of at least eight characters that
hold a digit or no small letter (see `spans`). Each is described by its length, its transitions between kinds of characters, how much
of it a dictionary covers, the path it was found under and the words beside it. The forest is fitted on a
bounded number of labelled findings on the driver; scanning needs no shuffle.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandtide.llm import exercises
from strandtide.llm.common import map_batches
from strandtide.llm.trees import Trees, forest

#: At most so many labelled findings of a corpus are used for fitting, chosen by a hash of their content, and so many
#: exercises of each kind (see `exercises`).
TRAINING_FINDINGS, EXERCISES = 20_000, 120
THRESHOLD = 0.5
LEAST = 8
CANDIDATE = re.compile(rf"(?<![A-Za-z0-9_+/\-])(?=[A-Za-z_+/\-]*[0-9]|[A-Z0-9_+/\-]{{{LEAST},}}(?![A-Za-z0-9_+/\-]))[A-Za-z0-9_+/\-]{{{LEAST},}}")
# Signed tokens of two or three parts, whose dots are no ends.
SIGNED = re.compile(r"(?<![\w\-])eyJ[\w\-]{8,}(?:\.[\w\-]{8,}){1,2}(?![\w\-])")
_AROUND = 48
# Names of settings that hold secrets, and words in paths of files that hold settings or examples.
SECRET_WORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "access_key", "private_key", "credential", "auth", "bearer", "key", "pass", "cred")
HASH_WORDS = ("commit", "sha", "etag", "md5", "checksum", "digest", "revision", "hash", "blob", "tree", "integrity", "uuid", "guid")
CONFIG_PATHS = ("env", "conf", "cfg", "ini", "yml", "yaml", "toml", "properties", "json", "pem", "key")
EXAMPLE_PATHS = ("test", "example", "sample", "mock", "doc", "fixture")
_SHORTEST = [w for w in SECRET_WORDS if not any(v in w for v in SECRET_WORDS if v != w)]
_NAMED = "|".join(_SHORTEST)
# The name and its sign (or a flag, or a scheme of authorization), then a value in quotes, or up to white space or the next setting of a row.
SETTING = re.compile(
    rf"(?:(?:{_NAMED})[\w.\-]{{0,64}}[\"'`\])]{{0,2}}\s*(?:=>|:=|==?|:|>)\s*(?:(?:bearer|basic|token)\s+)?|(?<=-)(?:{_NAMED})[\w\-]{{0,64}}\s+|\bbearer\s+)"
    r"""(?:"((?:[^"\\\n]|\\.)+)"|'((?:[^'\\\n]|\\.)+)'|`([^`\n]+)`|["'`]{0,3}([^\s"'`](?:(?![&,;?]["']?[\w.\-]+["']?[=:])\S)*))""",
    re.IGNORECASE,
)
# What an unquoted value may be without the signs that close or part it.
_BARE = re.compile(r"[^\s&,;|\"'`<>()\[\]{}]+")
URL_CREDENTIAL = re.compile(r"""://(?:[^\s:/@?#"'<>]*:(?:([^\s/"'<>]+)|([^\s"'<>]+))@|([^\s:/@?#"'<>]+)@)""")
QUOTED = re.compile(r"""["`](?=(?![,;:=()\[\]{}+]+["`])([^\s"`]+)["`])|(?:(?<!\w)|(?<=\b[bBrRuUfF]))'(?=(?![,;:=()\[\]{}+]+')([^\s']+)')|[“„«](?=([^\s“”„«»]+)[“”»])""")
_QUOTE = re.compile("[\"'`“„«]")


def dictionary(words, least: int = 4) -> frozenset[str]:
    """Lower-case words of at least `least` letters, ends-of-word marks removed."""
    plain = (w.removesuffix("</w>").lstrip("Ġ▁").lower() for w in words)
    return frozenset(w for w in plain if len(w) >= least and w.isalpha())


def coverage(text: str, known: frozenset[str], longest: int = 16) -> float:
    """Share of the characters inside dictionary words, longest first from the left."""
    low, i, hit = text.lower(), 0, 0
    while i < len(low):
        for n in range(min(longest, len(low) - i), 3, -1):
            if low[i : i + n] in known:
                hit += n
                i += n
                break
        else:
            i += 1
    return hit / len(text)


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def _last_word(before: str) -> str:
    found = re.findall(r"[A-Za-z_\-]+", before[-_AROUND:])
    return found[-1].lower() if found else ""


def describe(value: str, before: str, after: str, path: str, known: frozenset[str]) -> list[float]:
    """The forest's view of one candidate."""
    n, kinds = len(value), [_kind(c) for c in value]
    moves = Counter(zip(kinds, kinds[1:], strict=False))
    letters = Counter(value)
    entropy = -sum(k / n * math.log2(k / n) for k in letters.values())
    hexadecimal = sum(c in "0123456789abcdefABCDEF" for c in value) / n
    last, tail, low = _last_word(before), before[-4:], path.lower()
    following = re.match(r"\W*([A-Za-z]+)", after)
    return [
        n,
        *[kinds.count(k) / n for k in range(4)],
        *[moves[i, j] / n for i in range(4) for j in range(4)],
        entropy,
        hexadecimal,
        len(letters) / n,
        coverage(value, known),
        float(any(w in last for w in SECRET_WORDS)),
        float("=" in tail),
        float(":" in tail),
        float('"' in tail or "'" in tail),
        float(after[:1] in "\"'" and after[:1] != ""),
        float(before[-1:].isspace() or not before),
        len(last),
        len(following[1]) if following else 0,
        coverage(last, known) if last else 0.0,
        float(any(w in low for w in CONFIG_PATHS)),
        float(any(w in low for w in EXAMPLE_PATHS)),
        low.count("/"),
        float(any(w in last for w in HASH_WORDS)),
        float(after[:1] == "@"),
        float(_UUID.fullmatch(value) is not None),
        float(_DATED.fullmatch(value) is not None),
    ]


FEATURES = 1 + 4 + 16 + 4 + 16


_SECRET_SETTING = re.compile(r"(?i)(password|passwd|pwd|passphrase|secret|token|api_?key|access_?key|private_?key|credential)[\"']?\s*[=:]\s*([\"']?)$")
_HASH_SETTING = re.compile(r"(?i)(?<![a-z])(commit|sha-?\d*|etag|md5|checksum|digest|revision|rev|hash|blob|tree|parent|integrity)[\"']?[\s=:(]+[\"'(]*$")
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_DATED = re.compile(r"([A-Za-z]+[_/\-])*(19|20)\d\d([_/\-]?)(0[1-9]|1[0-2])\3(0[1-9]|[12]\d|3[01])(T\d{2,6}Z?)?([_/\-][A-Za-z]*)*")
# Variables, calls, placeholders and short words.
_DOUBTFUL = re.compile(rf"[$<({{%\[*].*|[\w.]*[(\[].*|[A-Za-z_]+(\.[A-Za-z_]+)+|[A-Za-z]{{0,{LEAST - 1}}}|(?i:(your|change|example|placeholder|insert|xxx).*)", re.DOTALL)


def known_label(value: str, before: str, after: str = "") -> int | None:
    """The label of a finding whose form or setting leaves no doubt, else None.

    1: a cloud access key id, a password in a URL, or the value of a setting named after a secret that is no
    variable, placeholder or plain word. 0: digits alone, letters alone that stand outside quotes and URLs, UUIDs,
    hashes after words like commit or etag, and names with a date, all without such a setting.
    """
    if re.fullmatch(r"A(KIA|SIA)[A-Z0-9]{16}", value):
        return 1
    if named := _SECRET_SETTING.search(before):
        plain = not named[2] and re.fullmatch("[A-Za-z]?[a-z]*", value)
        return None if plain or _DOUBTFUL.fullmatch(value) else 1
    if after[:1] == "@" and re.search(r"://[^\s:/@]*:$", before):
        return None if _DOUBTFUL.fullmatch(value) else 1
    if _UUID.fullmatch(value) or _DATED.fullmatch(value) or re.fullmatch(r"[0-9+\-/]+", value):
        return 0
    if re.fullmatch("[0-9a-fA-F]{7,}", value) and _HASH_SETTING.search(before):
        return 0
    if re.fullmatch(r"[A-Za-z_+/\-]+", value) and before[-1:] not in {*"\"'`“„«=:>"} and after[:1] != "@":
        return 0
    return None


def spans(text: str) -> list[tuple[int, int]]:
    """(start, stop) of all candidates of `text`, distinct and sorted; they may lie in one another.

    An unquoted value of a setting counts as it stands and, if it holds signs that close or part values, up to the
    first of them, too. Quotes elsewhere hold no white space.
    """
    found = {m.span() for m in CANDIDATE.finditer(text)}
    found.update(m.span() for m in SIGNED.finditer(text))
    found.update(m.span(m.lastindex) for m in URL_CREDENTIAL.finditer(text))
    found.update(m.span(m.lastindex) for q in _QUOTE.finditer(text) if (m := QUOTED.match(text, q.start())))
    past = 0
    for at in _named_at(text):
        if at < past or not (m := SETTING.match(text, at)):
            continue
        start, past = m.span(m.lastindex)
        found.add((start, past))
        if m.lastindex == 4 and (bare := _BARE.match(text, start, past)) and (kept := bare[0].rstrip(".:!?")):
            found.add((start, start + len(kept)))
    return sorted(found)


def _named_at(text: str) -> list[int]:
    """Places of the words that name secrets, in order."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    found = []
    for word in _SHORTEST:
        at = low.find(word)
        while at >= 0:
            found.append(at)
            at = low.find(word, at + 1)
    return sorted(found)


def candidates(docs: DataFrame, known: frozenset[str], path: str = "source") -> DataFrame:
    """`doc_id`, `start` (code points), `length`, `value_sha256`, `label` (see `known_label`), `x` for every candidate of every text.

    Null and empty texts have none; a null path counts as empty. Repeated rows give repeated findings, other columns are
    ignored, an empty table gives an empty result. Time follows the length of a text and of a value.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for batch in batches:
            rows = []
            for number, text, where in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("path").to_pylist(), strict=True):
                for start, stop in spans(text or ""):
                    before, after, value = text[max(0, start - _AROUND) : start], text[stop : stop + _AROUND], text[start:stop]
                    rows.append((number, start, len(value), hashlib.sha256(value.encode()).hexdigest(), known_label(value, before, after), describe(value, before, after, where or "", shared.value)))
            if rows:
                number, start, length, sha, label, x = zip(*rows, strict=True)
                flat = pa.array(np.array(x, dtype=np.float32).ravel())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(sha), pa.array(label, pa.int32()), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * FEATURES), flat)],
                    names=["doc_id", "start", "length", "value_sha256", "label", "x"],
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(path).cast("string").alias("path"))
    return map_batches(source, run, "doc_id long, start long, length long, value_sha256 string, label int, x array<float>")


def exercised(known: frozenset[str], seed: int, each: int, kinds=lambda kind: True) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all candidates of exercises: those that are most of the value have its label, those beside it are no
    secrets, and small parts of a secret are left out."""
    x, y = [], []
    for _, text, start, stop, label, path in exercises.lines(seed, each, kinds):
        for a, b in spans(text):
            shared = min(b, stop) - max(a, start)
            if label and 0 < shared <= 0.6 * (stop - start):
                continue
            x.append(describe(text[a:b], text[max(0, a - _AROUND) : a], text[b : b + _AROUND], path, known))
            y.append(label if shared > 0 else 0)
    return np.array(x, dtype=np.float32).reshape(-1, FEATURES), np.array(y, dtype=float)


def fit(findings: DataFrame, bound: int = TRAINING_FINDINGS, known: frozenset[str] | None = None, each: int = EXERCISES) -> Trees:
    """A forest for `label` of `findings` (as from `candidates`); null labels are left out. At most `bound` distinct
    findings are used, first in the order of their values' hashes; equal ones count once.

    With `known` (the dictionary) `each` exercises of every kind are learned, too: forms whose label no rule tells. Without
    any labels every score is 0.5.
    """
    rows = findings.where("label is not null").select("value_sha256", "label", "x").distinct().orderBy("value_sha256", "label", "x").limit(bound).toArrow()
    x = np.asarray(rows.column("x").combine_chunks().flatten(), dtype=np.float32).reshape(-1, FEATURES) if rows.num_rows else np.zeros((0, FEATURES), np.float32)
    y = rows.column("label").to_numpy().astype(float)
    if known is not None:
        more, labels = exercised(known, 1, each)
        x, y = np.concatenate([x, more]), np.concatenate([y, labels])
    return forest(x, y)


def scan(findings: DataFrame, model: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """`findings` with `score` and `is_secret`, without the features. Nothing is dropped: false positives are marked. A score of exactly
    `threshold` counts as a secret; a null id stays null."""
    shared = findings.sparkSession.sparkContext.broadcast(model)
    keep = ["doc_id", "start", "length", "value_sha256"]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column("x").flatten(), dtype=np.float32).reshape(-1, FEATURES)
                score = shared.value.total(x)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(score), pa.array(score >= threshold)], names=[*keep, "score", "is_secret"])

    return map_batches(findings.select(*keep, "x"), run, "doc_id long, start long, length long, value_sha256 string, score double, is_secret boolean")
