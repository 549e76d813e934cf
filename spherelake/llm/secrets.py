"""Secret scans: patterns find what is certain, a character network judges every other candidate.

Base spans come from three fixed patterns and always stay.  Every other candidate is
scored by a convolutional network over its characters and the characters around it.
Candidates are all runs of 16 token characters or more, whatever they are made of, and
those of 8 to 15 that are no plain word or number, or that a sign or a name announces as
a value (``pwd: ...``).  A long candidate is read whole, by stretches that overlap, and
gets its largest probability.  The network is written in numpy and trained on labelled
findings; its scores are calibrated by Platt scaling on findings kept apart, and the
threshold is the highest one that keeps a required recall there.

Findings are drawn by ``labelled_findings`` from a fixed seed: keys, tokens and
passwords of many shapes, with digits and without, against identifiers, digests, paths,
numbers and words that look alike.  The tables hold no labels of this kind.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
import uuid
from bisect import bisect_left
from collections.abc import Callable
from functools import lru_cache
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame

from spherelake.llm.common import map_texts, schema_with

#: The base kinds in their listed order, their patterns and least lengths (fixed values).
ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "model")
#: Runs of 16 token characters or more, and of 8 to 15 that are no plain word or number (but for stops at the end).
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-][A-Za-z0-9+/_.-]{15,}|(?!(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]+)[.-]*(?![A-Za-z0-9+/_.-]))[A-Za-z0-9+/_-][A-Za-z0-9+/_.-]{7,14})={0,2}")
#: Runs of 8 to 15 that are announced as a value by a sign or a name, plain words and numbers included.
_VALUE = r"(?<![A-Za-z0-9+/_-])([A-Za-z0-9+/_-][A-Za-z0-9+/_.-]{7,14}(?![A-Za-z0-9+/_.-])={0,2})"
SIGNED = re.compile(r"""[:=]\x20{0,2}["']?""" + _VALUE)
NAMES = ("pass", "pwd", "secret", "token", "key", "auth", "credential", "bearer", "login")
NAMED = re.compile(rf"""(?i:{'|'.join(NAMES)})[a-z]{{0,10}}["']?\x20(?:is\x20)?["']?{_VALUE}""")
#: What a text must hold, in lower case, to have a base span of the first kind.
ASSIGNED = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: The least characters of a candidate, and the least different ones: fewer are a line drawn across the page.
SHORTEST, VARIED = 8, 4
#: Characters of context on each side, and of the candidate's beginning and end, that the network reads.
CONTEXT, BODY = 24, 48
WIDTH = 2 * CONTEXT + BODY
#: Characters are read as classes: each ASCII character one, others by kind.
CLASSES = 100
FILTERS, KERNEL = 32, 5


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by the patterns: leftmost, non-overlapping in each kind; short matches dropped."""
    low = text.lower()
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6] if any(n in low for n in ASSIGNED) else []
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Candidate runs that no base span touches, in order; stops at a run's end belong to the sentence."""
    runs = {m.start(): m.end() for m in CANDIDATE.finditer(text)}
    low = text.lower()
    for announced in (SIGNED, NAMED) if any(n in low for n in NAMES) else (SIGNED,):
        for m in announced.finditer(text):
            runs.setdefault(m.start(1), m.end(1))
    out: list[tuple[int, int]] = []
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, e, _ in base), max))
    for a in sorted(runs):
        b = runs[a]
        while b > a and text[b - 1] in ".-":
            b -= 1
        if b - a < SHORTEST or out and out[-1][1] > a or len(set(text[a:b])) < VARIED:
            continue
        k = bisect_left(starts, b)  # spans that begin before the run's end
        if k == 0 or reach[k - 1] <= a:
            out.append((a, b))
    return out


def encode(text: str, a: int, b: int) -> np.ndarray:
    """The classes of the characters before, in and after a candidate; a long one keeps both ends."""

    def classes(s: str) -> list[int]:
        return [1 + min(ord(c), 128) - 32 if 32 <= ord(c) < 128 else 98 if c.isspace() else 99 for c in s]

    body = text[a:b]
    if len(body) > BODY:
        body = body[: BODY // 2] + body[len(body) - BODY // 2 :]
    before, after = text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT]
    row = [0] * (CONTEXT - len(before)) + classes(before) + classes(body) + [0] * (BODY - len(body)) + classes(after)
    return np.array(row + [0] * (WIDTH - len(row)), np.int64)


def windows(a: int, b: int) -> list[tuple[int, int]]:
    """What the network reads of a candidate: all of it, and of a long one stretches of BODY characters that overlap by half."""
    if b - a <= BODY:
        return [(a, b)]
    return [(a, b), *((s, s + BODY) for s in [*range(a, b - BODY, BODY // 2), b - BODY])]


class Network:
    """One convolution over the characters, pooled over the context before (largest), the body (mean and largest) and the context after (largest); two dense layers."""

    def __init__(self, parameters: dict[str, np.ndarray]):
        self.p = parameters

    @staticmethod
    def fresh(rng: np.random.Generator, hidden: int = 24) -> Network:
        def normal(*shape, fan):
            return rng.normal(0, (2 / fan) ** 0.5, shape).astype(np.float32)

        p = {"conv": normal(KERNEL, CLASSES, FILTERS, fan=KERNEL), "bias": np.zeros(FILTERS, np.float32)}
        p |= {"w1": normal(4 * FILTERS, hidden, fan=4 * FILTERS), "b1": np.zeros(hidden, np.float32), "w2": normal(hidden, fan=hidden), "b2": np.zeros(1, np.float32), "platt": np.array([1.0, 0.0, 0.5], np.float32)}
        return Network(p)

    def forward(self, rows: np.ndarray):
        """Logits and what the backward pass needs.  Regions: context before, body (its mean), context after, body (its largest)."""
        n = WIDTH - KERNEL + 1
        z = np.zeros((len(rows), n, FILTERS), np.float32) + self.p["bias"]
        for k in range(KERNEL):
            z += self.p["conv"][k][rows[:, k : k + n]]
        a = np.maximum(z, 0)
        body = slice(CONTEXT - KERNEL + 1, CONTEXT + BODY)
        regions = (slice(0, CONTEXT), body, slice(CONTEXT + BODY - KERNEL + 1, n), body)
        at = [a[:, r].argmax(1) + r.start for r in regions]
        x = np.concatenate([a[:, r].max(1) if i != 1 else a[:, r].mean(1) for i, r in enumerate(regions)], 1)
        h = np.maximum(x @ self.p["w1"] + self.p["b1"], 0)
        return h @ self.p["w2"] + self.p["b2"][0], (a, at, regions, x, h)

    def step(self, rows: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean logistic loss."""
        logit, (a, at, regions, x, h) = self.forward(rows)
        n = len(rows)
        d = ((1 / (1 + np.exp(-logit)) - y) / n).astype(np.float32)
        g = {"w2": h.T @ d, "b2": d.sum(keepdims=True)}
        dh = np.outer(d, self.p["w2"]) * (h > 0)
        g |= {"w1": x.T @ dh, "b1": dh.sum(0)}
        dx = dh @ self.p["w1"].T
        da = np.zeros_like(a)
        rows_at, f = np.arange(n)[:, None], np.arange(FILTERS)
        for i, r in enumerate(regions):
            part = dx[:, i * FILTERS : (i + 1) * FILTERS]
            if i == 1:
                da[:, r] += part[:, None, :] / (r.stop - r.start)
            else:
                np.add.at(da, (rows_at, at[i], f), part)
        da *= a > 0
        g["bias"] = da.sum((0, 1))
        conv = np.zeros_like(self.p["conv"])
        w = a.shape[1]
        flat = da.reshape(-1, FILTERS)
        for k in range(KERNEL):
            index = rows[:, k : k + w].ravel()
            order = np.argsort(index, kind="stable")
            at_class, begin = np.unique(index[order], return_index=True)
            conv[k][at_class] = np.add.reduceat(flat[order], begin)
        return g | {"conv": conv}

    def probability(self, rows: np.ndarray) -> np.ndarray:
        a, b, _ = self.p["platt"]
        return 1 / (1 + np.exp(-(a * self.forward(rows)[0] + b)))

    def flags(self, rows: np.ndarray) -> np.ndarray:
        return self.probability(rows) >= self.p["platt"][2]


#: Names that announce a credential, and names and words before other values (fixed values).
CREDENTIALS = "key auth credential access_key private signing bearer pwd pass passphrase client_secret session login pin".split()
OTHERS = "id request order user name file page commit version ref see note at on from by list item date phone number isbn code model".split()
SYLLABLES = "the and tion er ing es on re le de la que ent ver ge sch ar os ci ment ou".split()
MORE = "lich keit heit ung pf tz schaft ein zu au ber eau aux elle vi oi ier ado ista cion que nte wh st ble ly ough ska ij oe vo pro kt str ss th qu".split()


def labelled_findings(n: int = 10000, seed: int = 5) -> list[tuple[str, int, int, int]]:
    """(text, start, end, 1 for a secret) in equal shares, drawn from a fixed seed.

    A random string of fewer than 16 characters is a secret only where its surroundings
    announce one.
    """
    rng = random.Random(seed)
    letters = string.ascii_letters
    alnum, upper = letters + string.digits, string.ascii_uppercase + string.digits
    b64 = alnum + "+/"

    def chars(pool: str, a: int, b: int) -> str:
        return "".join(rng.choices(pool, k=rng.randint(a, b)))

    def word() -> str:
        return "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))

    def prose(k: int) -> str:
        return " ".join(word() for _ in range(k))

    def naming(names: list[str]) -> str:
        return rng.choice(["", f"{word()}_", f"{word()} "]) + rng.choice(names) + rng.choice([" = ", ": ", "=", ":", ' = "', '="', " is ", ' "'])

    def secret() -> tuple[str, str]:
        kind = rng.randrange(12)
        name = naming(CREDENTIALS)
        if kind == 0:
            return rng.choice(["", name]), chars(alnum, 20, 44)
        if kind == 1:
            return rng.choice(["", "Bearer ", "Authorization: Bearer "]), f"eyJ{chars(alnum, 16, 30)}.eyJ{chars(alnum, 20, 60)}.{chars(alnum + '_-', 30, 43)}"
        if kind == 2:
            return rng.choice(["", "use ", name]), rng.choice(["ghp_", "gho_", "ghs_", "glpat-", "npm_"]) + chars(alnum, 20, 40)
        if kind == 3:
            return rng.choice(["", name]), rng.choice(["sk_live_", "rk_live_", "pk_live_", "sk-", "key-", "SG."]) + chars(alnum, 24, 48)
        if kind == 4:
            return "", f"xox{rng.choice('bpa')}-{rng.randint(10**9, 10**11)}-{rng.randint(10**9, 10**11)}-{chars(alnum, 24, 24)}"
        if kind == 5:
            return rng.choice(["", "aws ", name]), chars(b64, 38, 42)
        if kind == 6:
            return "", "AIza" + chars(alnum + "_-", 35, 35)
        if kind == 7:
            return rng.choice(["", "key ", name]), chars(b64, 30, 60) + rng.choice(["=", "=="])
        if kind == 8:
            return rng.choice(["", "ASIA ", name]), chars(upper, 20, 32)
        if kind == 9:  # digits late or never
            return rng.choice(["", name]), chars(letters, 24, 90) + rng.choice(["", chars(string.digits, 1, 4)])
        if kind == 10:
            return name, chars(alnum, 8, 19)
        return name, rng.choice([chars(letters, 8, 15), chars(string.ascii_lowercase, 9, 15), word().capitalize() + chars(string.digits, 3, 5) + chars(letters, 2, 4), chars(alnum + "_-.", 8, 15)])

    def benign() -> tuple[str, str]:
        kind = rng.choice([*range(17), 9, 9, 9, 9, 12, 13, 13, 15, 15, 15, 15])
        other = rng.choice(["", "", naming(OTHERS)])
        if kind == 0:
            return rng.choice(["id ", "request ", other]), str(uuid.UUID(int=rng.getrandbits(128)))
        if kind == 1:
            return rng.choice(["https:", "see "]), f"//{word()}.example.com/{word()}/{rng.randint(1, 9999)}/{word()}-{word()}"
        if kind == 2:
            return other, f"{word()}_{word()}" + rng.choice(["", f"_{rng.randint(1, 99)}_{word()}"])
        if kind == 3:
            return rng.choice(["on ", "at ", other]), f"20{rng.randint(10, 30)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}" + rng.choice(["", f"T{rng.randint(10, 23)}-00-00Z"])
        if kind == 4:
            return other, f"{word()}-{word()}" + rng.choice(["", f"-{word()}", f"-{word()}-{rng.randint(1, 2030)}"])
        if kind == 5:
            return other, f"{word()}/{word()}" + rng.choice(["", f"/{word()}{rng.randint(0, 20)}.{word()}.{rng.choice(['py', 'html', 'json'])}"])
        if kind == 6:
            return other, f"{word()}{word()}{word()}" + rng.choice(["", str(rng.randint(0, 99))])
        if kind == 7:
            return rng.choice(["", "v"]), f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}-{word()}" + rng.choice(["", f".{word()}.{rng.randint(1, 99)}"])
        if kind == 8:
            return other, f"{word().capitalize()}{word().capitalize()}" + rng.choice(["", f"{word().capitalize()}{rng.randint(1, 9)}{word().capitalize()}"])
        if kind == 9:
            return other, rng.choice([str(rng.randint(10**7, 10**17)), chars(string.digits, 12, 19), f"{rng.randint(1, 99)}-{rng.randint(100, 999)}-{rng.randint(1000, 99999)}", f"+{rng.randint(10**9, 10**11)}", f"{rng.randint(100, 999)}-{rng.randint(100, 999)}-{rng.randint(1000, 9999)}"])
        if kind == 10:
            return naming(OTHERS), f"{word()}{word()}"
        if kind == 11:  # a short code that nothing announces as secret
            return rng.choice(["", "order ", "model ", "ref "]), rng.choice([chars(upper, 8, 12), f"{chars(string.ascii_uppercase, 2, 4)}-{rng.randint(1000, 999999)}"])
        if kind == 12:
            return rng.choice(["", "mail "]), f"{word()}.{word()}{rng.choice(['', str(rng.randint(1, 99)), f'.{rng.randint(0, 99):02}'])}"
        if kind == 13:
            host = f"{word()}{rng.choice(['', '', str(rng.randint(0, 99))])}.{word()}.{rng.choice(['com', 'org', 'net', 'de', 'example.com'])}"
            return rng.choice([(other, ".".join(word() for _ in range(rng.randint(3, 9)))), (f"{word()}{rng.choice(['', f'.{rng.randint(0, 99):02}'])}@", host), (rng.choice(["", "https://", "www."]), host)])
        if kind == 14:
            return naming(CREDENTIALS).replace('"', ""), rng.choice(["required", "undefined", "changeme-later", "not-set-yet", f"{word()}_{word()}_here", f"see-{word()}-{word()}"])
        if kind == 15:  # long words of any language, in all capitals
            w = "".join(rng.choices(SYLLABLES + MORE, k=rng.randint(4, 9)))
            return rng.choice(["", "", other]), rng.choice([w, w, w.capitalize(), w.upper(), w.upper(), f"{w}.{rng.randint(1, 99)}"])
        return other, (word() + rng.choice(["", "-", "_", "."])) * rng.randint(3, 9)

    out = []
    while len(out) < n:
        y = len(out) % 2
        before, body = secret() if y else benign()
        if len(body) < SHORTEST:
            continue
        head = f"{prose(rng.randint(0, 8))} {before}"
        after = rng.choice(["", "", ".", ",", "!!", "@mail.example.com" if not y else "", "\n", '"' if before.endswith('"') else ""])
        out.append((f"{head}{body}{after} {prose(rng.randint(0, 8))}", len(head), len(head) + len(body), y))
    return out


def long_stretches(n: int = 4000, seed: int = 7) -> list[tuple[str, int, int, int]]:
    """(text, start, end, 1 if it holds a key) for stretches of long runs: words in paths and names, every other run with a key amid them."""
    rng = random.Random(seed)
    alnum = string.ascii_letters + string.digits

    def word() -> str:
        w = "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))
        return rng.choice([w, w, w, w.capitalize(), str(rng.randint(0, 9999)), f"{w}{rng.randint(0, 99)}"])

    def run(least: int) -> str:
        out, sign = word(), rng.choice("/._-")
        while len(out) < least:
            out += (sign if rng.random() < 0.8 else rng.choice("/._-")) + word()
        return out

    out: list[tuple[str, int, int, int]] = []
    k = 0
    while len(out) < n:
        k += 1
        key = "".join(rng.choices(alnum + rng.choice(["", "+/", "_-"]), k=rng.randint(20, 44))) if k % 2 else ""
        front, sign = run(rng.randint(24, 90)), rng.choice("/._-")
        body = f"{front}{sign}{key}{sign}{run(rng.randint(24, 90))}"
        head, tail = " ".join(word() for _ in range(rng.randint(0, 6))) + " ", f" {word()}"
        at, to = len(head) + len(front) + 1, len(head) + len(front) + 1 + len(key)
        for a, b in windows(len(head), len(head) + len(body))[1:]:
            held = min(b, to) - max(a, at)
            if not key or held <= 0 or held >= 16:
                out.append((f"{head}{body}{tail}", a, b, int(bool(key) and held >= 16)))
    return out[:n]


def fit(findings: list[tuple[str, int, int, int]], recall: float = 0.98, rounds: int = 8, seed: int = 3) -> Network:
    """Train by Adam on four fifths of the findings and of stretches of long runs; calibrate and set the threshold on the rest."""
    rng = np.random.default_rng(seed)
    x = np.stack([encode(t, a, b) for t, a, b, _ in findings])
    y = np.array([f[3] for f in findings], np.float32)
    order = rng.permutation(len(x))
    train, apart = order[len(x) // 5 :], order[: len(x) // 5]
    stretches = long_stretches()
    more, cut = np.arange(len(x), len(x) + len(stretches)), len(stretches) // 5
    train, apart = np.concatenate([train, more[cut:]]), np.concatenate([apart, more[:cut]])
    x = np.concatenate([x, np.stack([encode(t, a, b) for t, a, b, _ in stretches])])
    y = np.append(y, np.array([f[3] for f in stretches], np.float32))
    net = Network.fresh(rng)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items() if k != "platt"}
    t, steps = 0, rounds * -(-len(train) // 64)
    for _ in range(rounds):
        rng.shuffle(train)
        for i in range(0, len(train), 64):
            t += 1  # the steps become smaller towards the end
            g = net.step(x[train[i : i + 64]], y[train[i : i + 64]])
            for k, (m, v) in moments.items():
                m += 0.1 * (g[k] - m)
                v += 0.001 * (g[k] ** 2 - v)
                net.p[k] -= 0.006 * (1.02 - t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)
    a, b = platt(net.forward(x[apart])[0], y[apart])
    net.p["platt"] = np.array([a, b, 0.5], np.float32)
    found = np.sort(net.probability(x[apart])[y[apart] == 1])
    # The highest threshold at which the required share of the secrets kept apart is found.
    net.p["platt"][2] = found[int(len(found) * (1 - recall))] if len(found) else 0.5
    return net


def platt(logit: np.ndarray, y: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Scale and shift of a logistic calibration, by Newton steps with smoothed targets."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    x = np.stack([logit.astype(float), np.ones(len(logit))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - target) + 1e-3 * (w - [1, 0]))
        w -= np.clip(step, -1, 1)
        if abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


@lru_cache(1)
def default_network() -> Network:
    return fit(labelled_findings())


def scan_texts(texts: list[str], net: Network) -> list[tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]]:
    """For each text its base spans, and all spans by start, then kind."""
    base = [base_spans(t) for t in texts]
    found = [(i, a, b) for i, t in enumerate(texts) for a, b in candidates(t, base[i])]
    read = [(j, a, b) for j, x in enumerate(found) for a, b in windows(*x[1:])]
    flagged = np.zeros(len(found), bool)  # if the largest probability of a candidate's windows reaches the threshold
    for k in range(0, len(read), 512):
        part = read[k : k + 512]
        hits = net.flags(np.stack([encode(texts[found[j][0]], a, b) for j, a, b in part]))
        flagged[[j for (j, _, _), hit in zip(part, hits) if hit]] = True
    extra: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    for (i, a, b), hit in zip(found, flagged):
        if hit:
            extra[i].append((a, b, "model"))
    return [(x, sorted(x + y, key=lambda s: (s[0], KINDS.index(s[2])))) for x, y in zip(base, extra)]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), network: Network | None = None) -> DataFrame:
    """``keep``, counts by base kind, ``base_sha256``, ``spans`` (kind:start:end joined by commas), ``n_model``.

    Null texts count as empty; whole texts are read.  Repeated rows each give a row, an
    empty table none.  Spans are in code points, the end exclusive.
    """
    parameters = (network or default_network()).p
    kept, schema = schema_with(docs, keep, "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_model bigint")
    def make() -> Callable:
        net = Network(parameters)

        def work(texts: list[str]) -> dict[str, object]:
            got = scan_texts(texts, net)
            count = lambda kind: [sum(s[2] == kind for s in x[1]) for x in got]
            return {
                "n_assign": count("assign"),
                "n_access": count("access"),
                "n_hex": count("hex"),
                "base_sha256": [hashlib.sha256(joined(x[0]).encode()).hexdigest() for x in got],
                "spans": [joined(x[1]) for x in got],
                "n_model": count("model"),
            }

        return work

    return map_texts(docs, kept, text, schema, make)
