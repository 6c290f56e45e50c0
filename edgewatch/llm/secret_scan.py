"""Secrets in texts: fixed patterns, and a character network for the tokens that no pattern names.

Candidates are all runs of at least ``MIN_CANDIDATE`` token characters, with or without digits, that do not
lie in one pattern's finding; a run that is longer than the finding it holds is one. Shorter runs, and
secrets with other characters than ``+/_.=-``, letters and digits, can only be found by the patterns. Runs are found for many texts at once by
byte masks; the patterns run only on texts that hold their fixed letters. The network sees each candidate
with its surroundings. It is trained on labelled findings: generated tokens of known kinds, secret and
harmless, put into contexts from a bounded sample of texts, and the patterns' own findings there.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewatch.llm.char_cnn import Network, windows
from edgewatch.llm.rows import column, keyed_texts, pieces

SAMPLE_DOCS = 500
CONTEXT_BYTES = 20_000
LABELLED = 6_000
RECALL = 0.95
MIN_CANDIDATE = 12
#: The patterns, the least length of what they must have matched, and their order.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "model")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_TOKEN = np.zeros(256, bool)
_TOKEN[list(b"+/_.=-" + string.ascii_letters.encode() + string.digits.encode())] = True
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True

#: Shapes of labelled tokens; {alphabet:length} or {alphabet:least-most} is drawn at random.
SECRET_SHAPES = (
    "ghp_{w:36}", "gho_{w:36}", "github_pat_{w:22}_{w:59}", "glpat-{w:20}", "xoxb-{d:12}-{d:12}-{w:24}",
    "xoxp-{d:11}-{d:11}-{h:32}", "sk_live_{w:24}", "rk_live_{w:24}", "sk-{w:48}", "AIza{b:35}", "ya29.{b:60}",
    "eyJ{b:17}.eyJ{b:40}.{b:43}", "SG.{b:22}.{b:43}", "key-{h:32}", "{b:40}", "{b:32}==", "{b:43}=", "{b:86}==",
    "{w:20-40}", "{h:18}", "{h:20-23}", "{h:32}", "{h:40}", "{h:64}", "pwd={w:10-16}", "auth={b:24}",
    "access_key={b:40}", "client-{w:32}", "npm_{w:36}", "dop_v1_{h:64}", "hf_{w:34}", "pypi-{b:60}",
    "AKIA{A:16}", "password={h:18}", "token={h:40}",
)
HARMLESS_SHAPES = (
    "{d:1-3}.{d:1-3}.{d:1-3}.{d:1-3}", "{d:16}", "{d:12-19}", "{d:3}-{d:3}-{d:4}", "{d:4}-{d:2}-{d:2}T{d:2}",
    "mail{d:1}.example.com", "{l:3-9}.{d:2}", "www.{l:5-9}{d:1}.example.org/{l:4-8}", "{l:4-9}/{l:4-9}-{d:1-4}.html",
    "v{d:1}.{d:1-2}.{d:1-2}-{l:3-6}", "{l:6-14}{d:1-2}", "{l:5-9}_{l:5-9}_{d:1-3}", "{d:3}.{d:3}.{d:3}-{d:2}",
    "{l:4-9}-{l:4-9}-{l:4-9}-{d:1-4}", "{d:1-3}/{d:1-3}/{d:4-6}", "978-{d:1}-{d:4}-{d:4}-{d:1}", "{l:12-30}",
    "img{d:4}.{l:3-5}", "chapter-{d:1-2}-{l:6-12}", "{d:1-2}...{d:1-2}...{d:1-2}...", "=========={d:1}=====",
    "{l:3-8}={d:1-4}", "section_{d:1-3}.{d:1-3}.{d:1-3}", "--------{d:2}-------", "+{d:2}-{d:3}-{d:3}-{d:4}",
)
ALPHABETS = {
    "d": string.digits, "h": "0123456789abcdef", "l": string.ascii_lowercase, "A": string.ascii_uppercase + string.digits,
    "w": string.ascii_letters + string.digits, "b": string.ascii_letters + string.digits + "-_",
}
SECRET_LEADS = ("key: ", "token ", "Authorization: Bearer ", "secret is ", "credential=", "auth ", '"', "'", " ", " ", "(")
HARMLESS_LEADS = (" ", " ", " ", "(", "see ", "call ", "@", "at ", "http://", "no. ", '"')
_HARMLESS = re.compile(r"[\d.,/+=_-]+|[a-z0-9-]+(\.[a-z0-9-]+)*\.(com|org|net)[/\w.-]*|[a-z]+\.\d+|[a-z]+\d{0,2}\.?", re.A)


# --- patterns and candidates --------------------------------------------------------------------


def _runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    first, last = edges[0::2], edges[1::2]
    long = last - first >= least
    return first[long], last[long]


def _pattern_spans(text: str, lowered: str) -> list[tuple[int, int, int]]:
    spans = []
    if any(w in lowered for w in ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    return spans


def scan(texts: list[bytes]) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Per text the base spans ``(start, kind, end)``; and candidates ``(text number, start, end)``.

    Offsets count code points. No candidate lies in one base span, but it can hold some.
    """
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    hexes = _runs(_HEX[raw], MIN_HEX)
    runs = _runs(_TOKEN[raw], MIN_CANDIDATE)
    hex_of, run_of = (np.searchsorted(starts, x[0], side="right") - 1 for x in (hexes, runs))
    busy = set(hex_of.tolist()) | set(run_of.tolist())
    base, candidates = [], []
    places = {}
    for kind, owners, (first, last) in (("hex", hex_of, hexes), ("run", run_of, runs)):
        for owner, a, b in zip(owners.tolist(), first.tolist(), last.tolist(), strict=True):
            places.setdefault((kind, owner), []).append((a - int(starts[owner]), b - int(starts[owner])))
    for i, own in enumerate(texts):
        lowered = own.lower()
        if i not in busy and b"akia" not in lowered and not any(w.encode() in lowered for w in ASSIGN_WORDS):
            base.append([])
            continue
        text = own.decode()
        spans = _pattern_spans(text, lowered.decode())
        point = np.arange(len(own) + 1)
        if len(text) < len(own):  # code points before each byte
            leads = raw[starts[i] : starts[i] + len(own)] & 0xC0 != 0x80
            point = np.concatenate(([0], np.cumsum(leads)))
        spans += [(int(point[a]), 2, int(point[b])) for a, b in places.get(("hex", i), ())]
        spans.sort()
        base.append(spans)
        reach = np.maximum.accumulate([0, *(e for _, _, e in spans)])
        begun = np.array([s for s, _, _ in spans])
        for a, b in places.get(("run", i), ()):
            a, b = int(point[a]), int(point[b])
            if reach[np.searchsorted(begun, a, side="right")] < b:
                candidates.append((i, a, b))
    return base, candidates


# --- training -----------------------------------------------------------------------------------


def _draw(shape: str, rng: random.Random) -> str:
    def part(m: re.Match) -> str:
        low, _, high = m[2].partition("-")
        return "".join(rng.choices(ALPHABETS[m[1]], k=rng.randint(int(low), int(high or low))))

    return re.sub(r"\{(\w):([\d-]+)\}", part, shape)


def generated(texts: list[str], n: int, rng: random.Random) -> list[tuple[str, int, int, bool]]:
    """``text, start, end, secret`` of tokens of known kinds in contexts from the texts; every other is secret."""
    out = []
    for i in range(n):
        secret = i % 2 == 0
        token = _draw(rng.choice(SECRET_SHAPES if secret else HARMLESS_SHAPES), rng)
        lead = rng.choice(SECRET_LEADS if secret else HARMLESS_LEADS)
        around = rng.choice(texts) if texts else ""
        at = rng.randrange(len(around) + 1)
        before = around[max(at - 40, 0) : at] + lead
        text = before + token + rng.choice((" ", '"', "\n", ".", ") ")) + around[at : at + 40]
        out.append((text, len(before), len(before) + len(token), secret))
    return out


def _covering(made: list[tuple[str, int, int, bool]]) -> tuple[list[bool], list[tuple[int, int] | None]]:
    """For each finding whether a base span covers it, and the candidate that does."""
    base, candidates = scan([text.encode() for text, *_ in made])
    runs: list[tuple[int, int] | None] = [None] * len(made)
    for i, s, e in candidates:
        if s <= made[i][1] and made[i][2] <= e:
            runs[i] = s, e
    known = [any(s <= m[1] and m[2] <= e for s, _, e in spans) for m, spans in zip(made, base, strict=True)]
    return known, runs


def labelled_findings(texts: list[str], n: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and labels: generated tokens in contexts from the texts, and findings inside the texts.

    A generated token is seen as the scan sees it, with the whole run that it is part of.
    """
    made = generated(texts, n, random.Random(seed))
    x, y = [], []
    for (text, s, e, secret), run in zip(made, _covering(made)[1], strict=True):
        own = windows(text, *(run or (s, e)))
        x += own
        y += [secret] * len(own)
    base, candidates = scan([t.encode() for t in texts])
    for text, spans in zip(texts, base, strict=True):
        own = [w for s, _, e in spans for w in windows(text, s, e)]
        x += own
        y += [True] * len(own)
    for i, s, e in candidates:
        if _HARMLESS.fullmatch(texts[i][s:e]) and not any(a < e and s < b for a, _, b in base[i]):
            own = windows(texts[i], s, e)
            x += own
            y += [False] * len(own)
    return np.array(x), np.array(y, np.float32)


def scores(made: list[tuple[str, int, int, bool]], model: Network) -> np.ndarray:
    """For each finding, end to end: 1 if a base span covers it, else its candidate's score, 0 without one."""
    known, runs = _covering(made)
    out = np.array(known, np.float64)
    for i, run in enumerate(runs):
        if run and not known[i]:
            out[i] = model.probabilities(np.array(windows(made[i][0], *run))).max()
    return out


def threshold(model: Network, texts: list[str], n: int, recall: float, seed: int = 17) -> float:
    """The greatest that gives fresh secrets without a base span the recall, those that are no candidates as missed."""
    made = [m for m in generated(texts, n, random.Random(seed)) if m[3]]
    unnamed = [m for m, known in zip(made, _covering(made)[0], strict=True) if not known]
    found = np.sort(scores(unnamed, model))
    least = float(found[int((1 - recall) * len(found))]) if len(found) else 0.0
    return least or model.threshold


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_docs: int = SAMPLE_DOCS,
    labelled: int = LABELLED,
    recall: float = RECALL,
) -> Network:
    """A network from ``labelled`` generated findings in contexts of about ``sample_docs`` texts.

    The texts are drawn by a hash of their ids among those of at most ``CONTEXT_BYTES``.
    """
    rows = keyed_texts(docs, id_col, text_col)
    share = F.lit(-(-1_000_000 * sample_docs // max(rows.count(), 1)))
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)), F.lit(1_000_000)) < share
    sized = F.octet_length("text").between(1, CONTEXT_BYTES)
    texts = sorted(r["text"] for r in rows.filter(drawn & sized).select("text").collect())
    model = Network().fit(*labelled_findings(texts, labelled), recall)
    model.threshold = threshold(model, texts, labelled // 2, recall)
    return model


# --- scanning -----------------------------------------------------------------------------------

FOUND = "doc_id long, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def find_secrets(docs: DataFrame, model: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` of each row's whole text, by start and then kind.

    Kinds are ``assign``, ``access``, ``hex`` (score 1) and ``model``, with its probability, for
    candidates at or above the model's threshold; a long candidate has the score of its best window.
    Null and empty texts have no spans. Repeated rows give repeated results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).cast("binary").alias("text")
    )
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for piece in pieces(batches):
            texts = [t or b"" for t in piece["text"].to_pylist()]
            base, candidates = scan(texts)
            found = [[(s, k, e, 1.0) for s, k, e in spans] for spans in base]
            for start in range(0, len(candidates), 256):
                some = candidates[start : start + 256]
                own = {i: texts[i].decode() for i, _, _ in some}
                inputs = [windows(own[i], s, e) for i, s, e in some]
                owner = np.repeat(np.arange(len(some)), [len(w) for w in inputs])
                p = np.zeros(len(some))
                np.maximum.at(p, owner, network.probabilities(np.array([w for row in inputs for w in row])))
                for (i, s, e), score in zip(some, p.tolist(), strict=True):
                    if score >= network.threshold:
                        found[i].append((s, 3, e, score))
            spans = [
                [{"kind": KINDS[k], "start": s, "end": e, "score": p} for s, k, e, p in sorted(row)] for row in found
            ]
            yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(spans, kind)], ["doc_id", "spans"])

    return rows.mapInArrow(find, FOUND)
