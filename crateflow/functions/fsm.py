"""Quote-aware tokenizer for delimited records, as a composable finite-state machine.

The bytes of many records stand in one buffer. Each byte is a function from state to state; functions
compose, so fixed-size chunks are reduced independently and side by side (one numpy step handles the
j-th byte of every chunk for every possible entry state). A prefix scan over the chunk functions gives
each chunk's true entry state, and a second sweep yields the state at every byte. A record may span
any number of chunks.
"""

from __future__ import annotations

import numpy as np

#: States. FIELD: at the start of a field; PLAIN: in a bare field; QUOTED: between quotes; CLOSE: after a quote inside
#: a quoted field; BAD: the record broke the quoting rule.
FIELD, PLAIN, QUOTED, CLOSE, BAD = range(5)
#: Byte classes.
OTHER, QUOTE, COMMA, BREAK, END = range(5)

#: STEP[class][state] -> state. END stands after each record and restarts the machine.
STEP = np.array(
    [
        [PLAIN, PLAIN, QUOTED, BAD, BAD],
        [QUOTED, BAD, CLOSE, QUOTED, BAD],
        [FIELD, FIELD, QUOTED, FIELD, BAD],
        [BAD, BAD, QUOTED, BAD, BAD],
        [FIELD, FIELD, FIELD, FIELD, FIELD],
    ],
    dtype=np.uint8,
)

_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[ord('"')] = QUOTE
_CLASS[ord(",")] = COMMA
_CLASS[[10, 13]] = BREAK

CHUNK = 64


def states_before(classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """The state in which the machine meets each byte."""
    n = len(classes)
    if n == 0:
        return np.zeros(0, dtype=np.uint8)
    rows = -(-n // chunk)
    padded = np.full(rows * chunk, END, dtype=np.uint8)
    padded[:n] = classes
    grid = padded.reshape(rows, chunk).T  # byte j of all chunks lies together
    maps = np.tile(np.arange(5, dtype=np.uint8), (rows, 1))
    for column in grid:
        maps = STEP[column[:, None], maps]
    # Inclusive prefix composition of the chunk functions by doubling.
    reach = 1
    while reach < rows:
        ahead = maps[reach:]
        maps = np.concatenate([maps[:reach], np.take_along_axis(ahead, maps[:-reach], axis=1)])
        reach *= 2
    state = np.empty(rows, dtype=np.uint8)
    state[0] = FIELD
    state[1:] = maps[:-1, FIELD]
    out = np.empty((chunk, rows), dtype=np.uint8)
    for j, column in enumerate(grid):
        out[j] = state
        state = STEP[column, state]
    return out.T.reshape(-1)[:n]


def tokenize(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Split the records buffer[starts[i]:ends[i]] into fields.

    Returns (bad_at, n_fields, field_start, field_end): per record the byte offset of the first break of
    the quoting rule (-1: none; the record's length: a quote was left open) and its field count, and per
    field, in order, where it lies in ``buffer``. A broken record has no fields.
    """
    n = len(starts)
    lengths = ends - starts
    # One END byte after each record.
    at = np.concatenate([[0], np.cumsum(lengths + 1)])
    total = int(at[-1])
    classes = np.full(total, END, dtype=np.uint8)
    owner = np.repeat(np.arange(n), lengths + 1)
    offset = np.arange(total) - at[owner]
    inside = offset < lengths[owner]
    source = starts[owner] + offset
    classes[inside] = _CLASS[buffer[source[inside]]]
    before = states_before(classes)
    after_bad = (STEP[classes, before] == BAD) & inside & (before != BAD)
    bad_at = np.full(n, -1, dtype=np.int64)
    first = np.flatnonzero(after_bad)[::-1]
    bad_at[owner[first]] = offset[first]
    record_end = at[1:] - 1
    left_open = (before[record_end] == QUOTED) & (bad_at < 0)
    bad_at[left_open] = lengths[left_open]
    stop = (~inside | ((classes == COMMA) & (before != QUOTED))) & (bad_at[owner] < 0)
    stops = np.flatnonzero(stop)
    n_fields = np.bincount(owner[stops], minlength=n).astype(np.int64)
    field_end = source[stops]
    field_start = np.empty_like(field_end)
    if len(stops):
        field_start[1:] = field_end[:-1] + 1
        head = np.concatenate([[True], owner[stops][1:] != owner[stops][:-1]])
        field_start[head] = starts[owner[stops][head]]
    return bad_at, n_fields, field_start, field_end
