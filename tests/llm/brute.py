"""Plain versions of the corpus operators over Python lists, for small inputs."""

from __future__ import annotations

import base64
import collections
import hashlib
import random
import re

import xxhash

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
SYLLABLES = "th er an in on re st nd ea ti ou ha es or en to it is ar al".split()


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    out = []
    for i in range(words):
        w = "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))
        out.append(w.capitalize() + "." if i % 12 == 11 else w)
    return " ".join(out)


def edited(text: str, seed: int, every: int) -> str:
    r = random.Random(seed)
    return " ".join("changed" + str(r.randint(0, 999)) if i % every == every // 2 else w for i, w in enumerate(text.split(" ")))


def secret_spans(text: str) -> list[tuple[int, int, int]]:
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii_spans(text: str) -> list[tuple[int, int, int]]:
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def listed(spans: list[tuple[int, int, int]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def fingerprint(text: str | None, k: int, bits: int) -> int:
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    count = collections.Counter()
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42) if bits == 64 else xxhash.xxh3_128_intdigest(g, 42)
        for b in range(bits):
            count[b] += h >> b & 1
    return sum(1 << b for b in range(bits) if 2 * count[b] > len(grams))


def groups(prints: list[int], sizes: list[int] | None, radius: int, ratio: float = 0.0) -> list[int]:
    """Group number of each fingerprint, linked within the radius."""
    parent = list(range(len(prints)))

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            near = (prints[i] ^ prints[j]).bit_count() <= radius
            if near and (not ratio or min(sizes[i], sizes[j]) >= ratio * max(sizes[i], sizes[j])) or prints[i] == prints[j]:
                parent[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(prints))]


def without_repeats(texts: list[str | None], length: int = 400) -> list[tuple[int, int, int, str]]:
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[i:i + length] for t in data for i in range(len(t) - length + 1))
    out = []
    for t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, sha(bytes(c for c, g in zip(t, gone, strict=True) if not g))))
    return out


def tiktoken_encoder():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
