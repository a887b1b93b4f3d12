"""The quality classifier and the pipeline's decisions again, row by row in plain Python."""

import hashlib
import math
import re
import zlib

import numpy as np

from gridzonal.llm import quality
from gridzonal.llm.text import _BYTE_HASH

M = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def mixed(value):
    value = (value ^ (value >> 30)) * 0xBF58476D1CE4E5B9 & M
    value = (value ^ (value >> 27)) * 0x94D049BB133111EB & M
    return value ^ (value >> 31)


SIGNS = [mixed((b + 1) * BASE & M) for b in range(256)]


def kind_of(byte):
    if chr(byte).isdigit() and byte < 128:
        return SIGNS[ord("0")]
    return 0 if byte >= 128 or chr(byte).isalpha() else SIGNS[byte]


def feature_indices(text):
    """The index of every feature of a text, repeats included."""
    found = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    hashes, shapes = [], []
    for word in found:
        lower = bytes(b + 32 if 65 <= b <= 90 else b for b in word)
        total = sum(int(_BYTE_HASH[b]) * pow(BASE, i, 1 << 64) for i, b in enumerate(lower))
        hashes.append(mixed((total + len(word)) & M))
        upper = sum(65 <= b <= 90 for b in word)
        letters = sum(97 <= b <= 122 or b >= 128 for b in word)
        capitals = upper >= 2 and letters == 0
        shapes.append(mixed((sum(map(kind_of, word)) + capitals * 0xA5A5A5A5A5A5A5A7 + 0xD1B54A32D192ED03) & M))
    out = [*hashes, *shapes]
    for k in range(len(found) - 1):
        out.append(mixed((hashes[k] * BASE + hashes[k + 1]) & M))
        again = 0xA5A5A5A5A5A5A5A7 if hashes[k] == hashes[k + 1] else 0
        out.append(mixed((shapes[k] * BASE + shapes[k + 1] + again) & M))
    return [value >> 46 for value in out]


class Learner:
    """One weight at a time; the key None is the bias."""

    def __init__(self, z, n):
        self.z, self.n = dict(z), dict(n)

    def weight(self, key):
        z = self.z.get(key, 0.0)
        return -z / ((quality.BETA + math.sqrt(self.n.get(key, 0.0))) / quality.ALPHA + quality.L2) if z else 0.0

    def learn(self, x, label):
        weights = {key: self.weight(key) for key in x}
        margin = max(-30.0, min(30.0, sum(weights[key] * value for key, value in x.items())))
        error = 1 / (1 + math.exp(-margin)) - label
        for key, value in x.items():
            g, n = error * value, self.n.get(key, 0.0)
            self.z[key] = self.z.get(key, 0.0) + g - (math.sqrt(n + g * g) - math.sqrt(n)) / quality.ALPHA * weights[key]
            self.n[key] = n + g * g


def quality_scores(docs, labels, order_of):
    """{doc_id: score}; ``order_of`` gives the hash by which rows are ordered and dealt to learners."""
    features = {i: feature_indices(text) for i, text in docs.items()}
    x = {}
    for i, indices in features.items():
        x[i] = {None: 1.0}
        for index in indices:
            x[i][index] = x[i].get(index, 0.0) + quality.SCALE / len(indices)
    taught = [i for i in labels if i in docs and labels[i] in (0, 1) and zlib.crc32(str(i).encode()) % 4 != 2]
    shards = {}
    for i in sorted(taught, key=lambda i: order_of[i]):
        shards.setdefault(order_of[i] % quality.SHARDS, []).append(i)
    z, n = {}, {}
    for number in range(quality.PASSES):
        learned = []
        for rows in shards.values():
            model = Learner(z, n)
            for k in np.random.default_rng(number).permutation(len(rows)):
                model.learn(x[rows[k]], labels[rows[k]])
            learned.append((len(rows) / len(taught), model))
        keys = {key for _share, model in learned for key in model.z}
        z, n = ({key: sum(share * getattr(m, part).get(key, 0.0) for share, m in learned) for key in keys} for part in "zn")
    final = Learner(z, n)
    return {i: 1 / (1 + math.exp(-sum(final.weight(key) * value for key, value in x[i].items()))) for i in docs}


def exact_kept(docs):
    """Ids that stay of equal texts."""
    last = {}
    for i, text in docs.items():
        digest = hashlib.sha256((text or "").encode()).digest()
        last[digest] = max(last.get(digest, i), i)
    return set(last.values())


def unit(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2**52


def poisson_count(rate, u):
    count, p = 0, math.exp(-rate)
    total = p
    while total <= u:
        count += 1
        p *= rate / count
        total += p
    return count


def copies(docs, source_of, seed, temperature):
    """{doc_id: how often it is in the mixture}."""
    sizes = {}
    for i, text in docs.items():
        sizes[source_of[i]] = sizes.get(source_of[i], 0) + max(1, len(text or ""))
    weight = {source: size**temperature for source, size in sizes.items()}
    rate = {s: weight[s] / sum(weight.values()) * sum(sizes.values()) / sizes[s] for s in sizes}
    return {i: poisson_count(rate[source_of[i]], unit(seed, i)) for i in docs}
