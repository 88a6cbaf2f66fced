"""A minimal acyclic transducer from words to id sequences, as flat arrays that can be memory-mapped."""

from __future__ import annotations

import json

import numpy as np

_MAGIC = b"lexicon1"


def compile_words(words: list[bytes]) -> dict[str, np.ndarray]:
    """Minimal automaton of strictly ascending, non-empty words; suffixes are shared.

    Built word by word: when the next word leaves a path, the states of that path are final and each
    is replaced by an equal state met before. Every edge carries how many words sort before the ones
    that go on through it, so the outputs along a word's path add up to the word's place in the list.
    Arrays: ``edges`` (state * 256 + byte, ascending), ``targets``, ``outputs``, ``final`` (by state).
    """
    known: dict[tuple, int] = {}
    children: list[list[tuple[int, int]]] = []  # by state
    finals: list[bool] = []
    path: list[list] = [[False, []]]  # open states of the current word: final, edges
    previous = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, edges = path.pop()
            key = (final, *edges)
            state = known.get(key)
            if state is None:
                state = known[key] = len(children)
                children.append(edges)
                finals.append(final)
            edge = path[-1][1]
            edge[-1] = (edge[-1][0], state)

    for word in words:
        if word <= previous:
            raise ValueError("words must be non-empty, distinct and in ascending order")
        shared = 0
        limit = min(len(word), len(previous))
        while shared < limit and word[shared] == previous[shared]:
            shared += 1
        close(shared)
        for byte in word[shared:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0] = True
        previous = word
    close(0)
    children.append(path[0][1])
    finals.append(False)

    n = len(children)
    below = [0] * n  # words that end at or below a state; children come before parents
    keys, targets, outputs = [], [], []
    for state in range(n):
        total = int(finals[state])
        for byte, child in children[state]:
            keys.append(state * 256 + byte)
            targets.append(child)
            outputs.append(total)
            total += below[child]
        below[state] = total
    return {
        "edges": np.array(keys, np.int64),
        "targets": np.array(targets, np.int32),
        "outputs": np.array(outputs, np.int32),
        "final": np.array(finals, np.bool_),
    }


def find_words(automaton: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """Place of each word in the compiled list, or -1; all words take each step together."""
    found = np.full(len(words), -1, np.int64)
    edges, targets, outputs, final = (automaton[k] for k in ("edges", "targets", "outputs", "final"))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    alive = np.flatnonzero(lengths > 0)
    if not len(edges) or not len(alive):
        return found
    starts = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(words), np.uint8)
    state = np.full(len(alive), len(final) - 1, np.int64)
    place = np.zeros(len(alive), np.int64)
    depth = 0
    while len(alive):
        key = state * 256 + data[starts[alive] + depth]
        at = np.minimum(np.searchsorted(edges, key), len(edges) - 1)
        on = edges[at] == key
        alive, at = alive[on], at[on]
        state, place = targets[at].astype(np.int64), place[on] + outputs[at]
        depth += 1
        ends = lengths[alive] == depth
        hit = ends & final[state]
        found[alive[hit]] = place[hit]
        alive, state, place = alive[~ends], state[~ends], place[~ends]
    return found


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """Arrays as one file: a header with names, types and places, then the arrays at multiples of 64."""
    head, parts, at = {}, [], 0
    for name, value in arrays.items():
        data = np.ascontiguousarray(value).tobytes()
        head[name] = (value.dtype.str, at, len(value))
        parts.append(data + bytes(-len(data) % 64))
        at += len(parts[-1])
    header = json.dumps(head).encode()
    header += b" " * (-(len(header) + 16) % 64)
    return _MAGIC + len(header).to_bytes(8, "little") + header + b"".join(parts)


def open_packed(path: str) -> dict[str, np.ndarray]:
    """Memory-map a packed file: pages are read when needed and shared by the workers of a machine."""
    file = np.memmap(path, np.uint8, "r")
    if bytes(file[:8]) != _MAGIC:
        raise ValueError(f"{path} is no packed lexicon")
    size = int.from_bytes(bytes(file[8:16]), "little")
    head = json.loads(bytes(file[16 : 16 + size]))
    base = 16 + size
    arrays = {}
    for name, (kind, at, n) in head.items():
        kind = np.dtype(kind)
        arrays[name] = file[base + at : base + at + n * kind.itemsize].view(kind)
    return arrays
