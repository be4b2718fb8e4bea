"""Personal data: a semi-Markov conditional random field over candidate segments.

Pattern scanners propose whole segments: strict ones (the base kinds), looser spellings of the same kinds,
and parts, at the borders of groups of digits, of runs of digits that fail the strict check as a whole.
Each segment is scored as a whole, from its shape, its check digits and the words before it. A dynamic
program over the segments of a text, whose length is bounded for loose numbers, chooses boundaries and
kinds jointly: the best set of segments that do not overlap, everything else being outside. Strict
segments are always kept, also where two kinds overlap; the model adds loose ones.

The weights are learned here, by gradient ascent on the field's likelihood (forward-backward over the
same segments). Examples are strict segments found in the corpus, respelled in the loose ways, against
candidates such as plain numbers that must stay outside. The sample is bounded: TRAIN_TEXTS texts, the
first by hash of doc_id among those that show signs of strict segments, TRAIN_WINDOWS places of each.

Nulls: a null text is empty and holds nothing. Repeated rows give repeated results.
"""

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wiremere.llm import words
from wiremere.llm.tables import prepare

KINDS = ["email", "ip", "card", "phone"]
MAX_LOOSE = 80  # longest loose segment but for e-mails, in characters
CONTEXT = 24  # characters before a segment that its score sees
TRAIN_TEXTS = 300
TRAIN_WINDOWS = 20  # of each of these texts
GLUED = 3  # one of so many cards and phones is also shown glued to a number
STEPS, RATE, DECAY = 300, 0.5, 1e-3
MARGIN = 1.0  # log-odds a loose segment must reach over staying outside

# The base patterns, each from its first character that can begin a match, so that a
# scan takes linear time. An e-mail's local part is read backwards from its @.
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser spellings.
LOOSE = {
    # From the sign on, with whole labels; the local part before it is read backwards, as in the strict scan.
    "email": re.compile(r"[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++){1,3}(?:\.[A-Za-z0-9-]++)*"),
    "phone": re.compile(r"(?<![\w+.(-])(?:(?:\+|00)[1-9][0-9]{0,2}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])"),
    "card": re.compile(r"(?<![\w.-])[0-9]{4}(?:(?:[._/]?[0-9]{4}){2}[._/]?[0-9]{2,7}|[._/][0-9]{6}[._/][0-9]{4,5})(?!\w|[.-]\w)"),
    "ip": re.compile(r"(?<![\w.])[0-9]{1,3}(?: ?[\[(]\.[\])] ?[0-9]{1,3}){3}(?![\w.])"),
}
LOOSE_SIGN = {"email": ("[at", "(at"), "ip": ("[.]", "(.)")}
GROUP = re.compile(r"[0-9]+")
# Usual groups of a card's digits, besides one group.
CARD_GROUPS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (6, 13), (4, 4, 4, 4, 1), (4, 4, 4, 4, 2), (4, 4, 4, 4, 3)}
CUES = {
    "email": ("mail", "contact", "write", "reach"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "pay", "credit"),
    "phone": ("call", "phone", "tel", "fax", "mobile"),
}

Segment = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_segments(text: str) -> list[Segment]:
    """All strict segments, by start, then kind."""
    found: list[Segment] = []
    free, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                found.append((start, domain.end(), 0))
                free = domain.end()
        at = text.find("@", max(at + 1, free))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), m.end(), 1))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


def glued_segments(text: str) -> list[Segment]:
    """Parts, at group borders, of the runs of digits that fail the strict check as a whole."""
    found = []
    for m in CARD.finditer(text):
        digits = _digits(m.group()) if m.end() - m.start() >= 14 else ""
        if len(digits) < 14 or len(digits) <= 19 and luhn(digits):
            continue
        groups = [g.span() for g in GROUP.finditer(text, *m.span())]
        for i, (start, _) in enumerate(groups):
            n = 0
            for begin, end in groups[i:i + 19]:
                n += end - begin
                if n > 19:
                    break
                if n >= 14 and luhn(_digits(text[start:end])):
                    found.append((start, end, 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            n, most = 0, len(_digits(m.group()))
            if most <= 15:
                continue
            for g in GROUP.finditer(text, *m.span()):
                n += g.end() - g.start()
                if n > 15:
                    break
                if n >= 10:
                    found.append((m.start(), g.end(), 3))
    return found


def loose_emails(text: str) -> list[Segment]:
    """Candidates with a written-out @: the whole local part before the sign."""
    found = []
    for sign in LOOSE_SIGN["email"]:
        at, free = text.find(sign), 0
        while at >= 0:
            m = LOOSE["email"].match(text, at)
            if m:
                end = at - 1 if at > free and text[at - 1] == " " else at
                start = end
                while start > free and text[start - 1] in LOCAL:
                    start -= 1
                if start < end:
                    found.append((start, m.end(), 0))
                    free = m.end()
            at = text.find(sign, max(at + 1, free))
    return found


def loose_segments(text: str) -> list[Segment]:
    """Candidates in looser spellings or glued to their neighbours, by start."""
    found = glued_segments(text)
    for kind, name in enumerate(KINDS):
        if name == "email":
            continue
        signs = LOOSE_SIGN.get(name)
        if signs is None:
            found += [(m.start(), m.end(), kind) for m in LOOSE[name].finditer(text)]
            continue
        for sign in signs:
            at, free = text.find(sign), 0
            while at >= 0:
                # The sign stands inside the segment, so only its surroundings are searched.
                low = max(free, at - MAX_LOOSE)
                m = next((m for m in LOOSE[name].finditer(text, low, at + MAX_LOOSE) if m.end() > at), None)
                if m and m.start() <= at:
                    found.append((m.start(), m.end(), kind))
                    free = m.end()
                at = text.find(sign, max(at + 1, free))
    return sorted({s for s in found if s[1] - s[0] <= MAX_LOOSE} | set(loose_emails(text)))


def free_segments(text: str, strict: list[Segment]) -> list[Segment]:
    """Loose candidates that touch no strict segment."""
    loose = loose_segments(text)
    if not loose or not strict:
        return loose
    starts, ends = [s for s, _, _ in strict], sorted(e for _, e, _ in strict)
    # As many have ended before its start as have begun before its end.
    return [c for c in loose if bisect_right(ends, c[0]) == bisect_left(starts, c[1])]


N_SHAPES = 11
N_FEATURES = len(KINDS) * N_SHAPES


def describe(text: str, segment: Segment) -> np.ndarray:
    """Features of a whole segment, in the block of its kind."""
    start, end, kind = segment
    body = text[start:end]
    digits = _digits(body)
    before = text[max(0, start - CONTEXT) : start].lower()
    parts = re.split(r"\D+", body.strip("+()"))
    sizes = tuple(g.end() - g.start() for g in GROUP.finditer(body))
    if kind == 2:
        regular = luhn(digits) and (len(sizes) == 1 or sizes in CARD_GROUPS)
    else:
        regular = kind == 3 and body[0] == "+" and len(sizes) <= 6 and max(map(len, GROUP.split(body))) <= 2
    shape = [
        1.0,
        float(luhn(digits)) if len(digits) >= 12 else 0.0,
        float(10 <= len(digits) <= 15),
        float(14 <= len(digits) <= 19),
        float("(" in body or "[" in body),
        float(any(len(p) == 4 for p in parts[-1:])),
        float(all(p.isdigit() and int(p[-4:]) <= 255 for p in parts if p)),
        float(any(c.isalpha() for c in re.sub(r"[\[(](?:at|dot)[\])]", "", body))),
        float(any(c in before for c in CUES[KINDS[kind]])),
        float(regular),
        float(kind > 1 and len(sizes) > 6),
    ]
    out = np.zeros(N_FEATURES)
    out[kind * N_SHAPES : (kind + 1) * N_SHAPES] = shape
    return out


def best(segments: list[Segment], scores: np.ndarray) -> list[int]:
    """Viterbi over segments: the set without overlaps of highest score; outside scores 0."""
    order = sorted(range(len(segments)), key=lambda i: (segments[i][1], segments[i][0]))
    ends = [segments[i][1] for i in order]
    value, take = [0.0], []
    for n, i in enumerate(order):
        last = bisect_right(ends, segments[i][0], 0, n)
        with_it = value[last] + scores[i]
        take.append(last if with_it > value[n] else -1)
        value.append(max(with_it, value[n]))
    chosen, n = [], len(order)
    while n:
        if take[n - 1] < 0:
            n -= 1
        else:
            chosen.append(order[n - 1])
            n = take[n - 1]
    return chosen


def marginals(segments: list[Segment], scores: np.ndarray) -> np.ndarray:
    """Forward-backward over the same lattice: probability of each segment."""
    by_end = sorted(range(len(segments)), key=lambda i: segments[i][1])
    ends = [segments[i][1] for i in by_end]
    forward = [0.0]
    for n, i in enumerate(by_end):
        last = bisect_right(ends, segments[i][0], 0, n)
        forward.append(float(np.logaddexp(forward[n], forward[last] + scores[i])))
    by_start = sorted(range(len(segments)), key=lambda i: -segments[i][0])
    starts = [-segments[i][0] for i in by_start]
    backward = [0.0]
    for n, i in enumerate(by_start):
        last = bisect_right(starts, -segments[i][1], 0, n)
        backward.append(float(np.logaddexp(backward[n], backward[last] + scores[i])))
    out = np.zeros(len(segments))
    for i, (start, end, _) in enumerate(segments):
        left, right = forward[bisect_right(ends, start)], backward[bisect_right(starts, -end)]
        out[i] = np.exp(left + scores[i] + right - forward[-1])
    return out


def respell(body: str, kind: int, turn: int) -> str:
    """A loose spelling of a strict segment."""
    if kind == 0:
        local, host = body.split("@", 1)
        return [f"{local} [at] {host}", f"{local}(at){host}", f"{local} (at) {host.replace('.', ' [dot] ')}"][turn % 3]
    if kind == 1:
        return body.replace(".", ["[.]", "(.)"][turn % 2])
    digits = _digits(body)
    if kind == 2:
        return ["_", ".", "/", ""][turn % 4].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    tail = digits[-10:]
    return [f"({tail[:3]}) {tail[3:6]}-{tail[6:]}", f"{tail[:3]}-{tail[3:6]}-{tail[6:]}", f"001 {tail[:3]} {tail[3:6]} {tail[6:]}"][turn % 3]


def glued(body: str, kind: int, turn: int) -> tuple[str, str, str]:
    """A card or phone in usual groups, a number to stand right after it, and its digits with some more
    in small groups, which are neither."""
    digits = _digits(body)
    if kind == 2:
        sizes = {14: (4, 6, 4), 15: (4, 6, 5)}.get(len(digits), (4, 4, 4, 4, 3))
        ends = np.cumsum(sizes).tolist()
        body = " -"[turn % 2].join(filter(None, (digits[e - n : e] for e, n in zip(ends, sizes))))
        after = [" 12/27", " 123", " 5500 0055 5555 5559", " 2024"][turn // 2 % 4]
        return body, after, " ".join(re.findall("..", digits + "7351902846"))
    after = [" 10.0.0.1", " 4111111111111111", " - 2024-01-02", " 555 1234"][turn % 4]
    return body, after, "+" + " ".join(digits + "735190284")


def examples(texts: list[str]) -> list[tuple[list[Segment], np.ndarray, np.ndarray]]:
    """Windows around strict segments, respelled, with their candidates and which of them are true.

    Every window has a twin in which the digits are changed so that no check holds and no cue stands
    before it: its candidates are false. Of every GLUED cards and phones one also stands glued to a number,
    with a twin in small groups of digits whose candidates are false.
    """
    out = []
    for t, text in enumerate(texts):
        for n, (start, end, kind) in enumerate(base_segments(text)):
            turn = t + n
            body = respell(text[start:end], kind, turn)
            # Whole words around it: a cut number would be a false example by accident.
            lead = text[max(0, start - CONTEXT) : start].partition(" ")[2].rsplit("+", 1)[-1]
            tail = text[end : end + CONTEXT].rpartition(" ")[0]
            cue = ["", f" {CUES[KINDS[kind]][turn % len(CUES[KINDS[kind]])]}: "][turn // 3 % 2]
            window = f"{lead}{cue} {body} {tail}"
            true = (len(lead) + len(cue) + 1, len(lead) + len(cue) + 1 + len(body), kind)
            false = f"{lead} " + "".join(chr(48 + (ord(c) * 7 + turn + i) % 10) if c.isdigit() else c for i, c in enumerate(body))
            for made, answer in ((window, true), (false, None)):
                if answer is None and kind != 2:
                    continue
                segments = free_segments(made, base_segments(made))
                if answer is None:
                    segments = [s for s in segments if not luhn(_digits(made[s[0] : s[1]]))]
                if segments:
                    x = np.stack([describe(made, s) for s in segments])
                    out.append((segments, x, np.array([float(s == answer) for s in segments])))
            if kind < 2 or turn % GLUED:
                continue
            whole, after, small = glued(text[start:end], kind, turn // GLUED)
            at = len(lead) + len(cue) + 1
            answers = [(at, at + len(whole), kind)]
            if len(_digits(after)) == 16:  # a card too
                answers.append((answers[0][1] + 1, answers[0][1] + len(after), 2))
            for made, answers in ((f"{lead}{cue} {whole}{after} {tail}", answers), (f"{lead} {small} {tail}", [])):
                segments = free_segments(made, base_segments(made))
                if segments and set(answers) <= set(segments):
                    x = np.stack([describe(made, s) for s in segments])
                    out.append((segments, x, np.array([float(s in answers) for s in segments])))
    return out


def train(texts: list[str]) -> np.ndarray:
    """Weights that raise the likelihood of the true segments; a start in favour of checks."""
    weights = np.zeros((len(KINDS), N_SHAPES))
    # Where the sample shows nothing of a kind, its segments need a check or a cue to be taken.
    weights[:, 0] = [0.0, 0.0, -4.0, -1.0]
    weights[2:, 9] = 4.0
    weights[2:, 10] = -4.0
    weights[:, 8] = 2.0
    weights[2, 1] = 4.0
    weights[1, 6] = 2.0
    start = weights.reshape(-1)
    weights = start.copy()
    lattices = examples(texts)
    # A lattice of one segment is a logistic choice; those are summed at once.
    single = [(x, truth) for found, x, truth in lattices if len(found) == 1]
    several = [lattice for lattice in lattices if len(lattice[0]) > 1]
    xs = np.concatenate([x for x, _ in single]) if single else np.zeros((0, len(weights)))
    ys = np.concatenate([truth for _, truth in single]) if single else np.zeros(0)
    for _ in range(STEPS if lattices else 0):
        gradient = -DECAY * len(lattices) * (weights - start)
        gradient += (ys - 1 / (1 + np.exp(-(xs @ weights)))) @ xs
        for found, x, truth in several:
            gradient += (truth - marginals(found, x @ weights)) @ x
        weights += RATE * gradient / len(lattices)
    return weights


def segments(text: str, weights: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """All segments of a text: strict ones, and loose ones that the field chooses beside them."""
    strict = base_segments(text)
    found = [(s, e, k, True) for s, e, k in strict]
    loose = free_segments(text, strict)
    if loose:
        scores = np.stack([describe(text, c) for c in loose]) @ weights - MARGIN
        found += [(*loose[i], False) for i in best(loose, scores)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def redact(text: str, found: list[tuple[int, int, int, bool]]) -> str:
    """The text with each run of overlapping segments replaced by the kind of its first."""
    out, at = [], 0
    for start, end, kind, _ in found:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"
_ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
)


def learn(docs: DataFrame) -> np.ndarray:
    """Weights from a bounded sample of the texts that hold strict segments."""
    # A cheap necessary sign of a strict segment; the scanners decide.
    sign = F.col("text").rlike(r"@[A-Za-z0-9-]+\.|\+[0-9]|[0-9]{4}[ -]?[0-9]{4}|[0-9]\.[0-9]+\.[0-9]")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Ids first: tasks send ids to the driver, not texts, and only the chosen ones' windows follow.
    order = [F.xxhash64("doc_id"), "doc_id"]
    ids = texts.filter(sign & F.col("doc_id").isNotNull()).select("doc_id").distinct().orderBy(*order).limit(TRAIN_TEXTS)
    ids = [r["doc_id"] for r in ids.collect()]
    windows = F.regexp_extract_all("text", F.lit(r"(?s)(.{0,60}(?:@|\+[0-9]|[0-9]{4}|[0-9]\.[0-9]+\.[0-9]).{0,80})"), 1)
    chosen = texts.filter(F.col("doc_id").isin(ids)).select("doc_id", F.array_join(F.slice(windows, 1, TRAIN_WINDOWS), " ").alias("w"))
    parts = chosen.groupBy("doc_id").agg(F.min("w").alias("w")).orderBy("doc_id")
    return train([r["w"] for r in parts.collect() if r["w"]])


def find(docs: DataFrame, weights: np.ndarray | None = None, redacted: bool = False) -> DataFrame:
    """docs with `spans`; with `redacted`, also with each segment in the text replaced by its kind."""
    prepare(docs.sparkSession)
    weights = learn(docs) if weights is None else weights
    kept = [c for c in docs.columns if c != "spans" and not (redacted and c == "text")]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept) + f", spans {SPANS}"
    schema += ", text string" if redacted else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(kept))
            for start, end in words.slices(column, 1 << 22):
                texts = column.slice(start, end - start).to_pylist()
                found = [segments(t, weights) if t else [] for t in texts]
                rows = [[{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, e, k, b in f] for f in found]
                columns = [batch.column(i).slice(start, end - start) for i in range(len(kept))]
                columns.append(pa.array(rows, _ARROW_SPANS))
                if redacted:
                    columns.append(pa.array([t and redact(t, f) for t, f in zip(texts, found)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*kept, "spans", *(["text"] if redacted else [])])

    inputs = [*[F.col(f"`{c}`") for c in kept], F.col("text").cast("string").alias("_text")]
    return docs.select(inputs).mapInArrow(run, schema)
