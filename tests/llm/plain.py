"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from bisect import bisect_left, insort
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def removed(sequences, window):
    """For each sequence, the marks of what lies in a window that starts more than once."""
    seen = Counter(s[i : i + window] for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        marks = bytearray(len(s))
        for i in range(len(s) - window + 1):
            if seen[s[i : i + window]] > 1:
                marks[i : i + window] = b"\1" * window
        out.append(marks)
    return out


def phrases(text, marks):
    words = WORD.findall(text or "")
    kept = [w for w, m in zip(words, marks, strict=True) if not m]
    return len(words), sum(marks), hashlib.sha256(" ".join(kept).encode()).hexdigest()


def strings(text, marks):
    data = (text or "").encode()
    spans = sum(1 for i, m in enumerate(marks) if m and not (i and marks[i - 1]))
    return len(data), sum(marks), spans, hashlib.sha256(bytes(b for b, m in zip(data, marks, strict=True) if not m)).hexdigest()


def shingles(text):
    words = WORD.findall(text or "")
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_classes(texts, least=0.8):
    """The class number of each text; texts without words are alone."""
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        shared = Counter(j for g in own for j in holders[g])
        for j, n in shared.items():
            if n >= least * (len(own) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for g in own:
            holders[g].append(i)
    return [root(i) for i in range(len(texts))]


def best_fit(lengths, capacity):
    """How many sequences best-fit decreasing opens."""
    rooms, opened = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect_left(rooms, length)
        if at == len(rooms):
            opened += 1
            room = capacity
        else:
            room = rooms.pop(at)
        if room > length:
            insort(rooms, room - length)
    return opened


def item_words(text):
    return re.findall("[^\\x00-\\x2f\\x3a-\\x40\\x5b-\\x60\\x7b-\\x7f]+", (text or "").lower())


def best_distance(item, words):
    """Edit distance of the item to the nearest stretch of the words."""
    row = [0] * (len(words) + 1)
    for a in item:
        above, row = row, [row[0] + 1]
        for j, b in enumerate(words):
            row.append(min(above[j] + (a != b), above[j + 1] + 1, row[j] + 1))
    return min(row)
