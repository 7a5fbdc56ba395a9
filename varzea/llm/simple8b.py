"""Simple-8b: unsigned integers packed into 64-bit words.

The low four bits of a word are its selector, the other sixty hold as many
equally wide integers as the selector says: 60 of 1 bit, 30 of 2 ... 1 of 60.
A word takes the most integers that fit from where it starts (greedy); the last
word of a stream is filled up with zeros and the stream's length tells how many
count.  An integer of more than 60 bits is escaped: a word with the selector
``ESCAPE``, then the integer as it is.

Both ways work on whole arrays: encoding finds the widest selector for every
place at once and then finds the word starts by doubling jumps; decoding shifts
all words of one selector together.
"""

from __future__ import annotations

import numpy as np

PAYLOAD = 60
#: (integers in a word, bits of each), most integers first.
SELECTORS = [(n, PAYLOAD // n) for n in (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)]
ESCAPE = 15
_FOUR = np.uint64(4)


def encode(values: np.ndarray) -> np.ndarray:
    """uint64 words of an array of unsigned integers."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64)
    choice = np.full(n, -1, np.int8)
    for s in range(len(SELECTORS) - 1, -1, -1):  # fewest integers first, so that the most win
        count, bits = SELECTORS[s]
        fit = np.flatnonzero(values <= np.uint64((1 << bits) - 1))
        if not len(fit):
            break
        begin = fit[:max(0, len(fit) - count + 1)]
        choice[begin[fit[count - 1:] - begin == count - 1]] = s
        tail = fit[max(0, len(fit) - count):]
        choice[tail[tail - n == np.arange(-len(tail), 0)]] = s  # filled up
    counts = np.array([c for c, _ in SELECTORS] + [1])
    jump = np.append(np.minimum(np.arange(n) + counts[choice], n), n)
    start = np.zeros(1, np.int64)
    while start[-1] < n:  # the first 2^k word starts, and the jump over 2^k words
        start, jump = np.concatenate([start, jump[start]]), jump[jump]
    start = start[start < n]
    chosen = choice[start]
    size = np.where(chosen < 0, 2, 1)
    place = np.cumsum(size) - size
    words = np.empty(int(size.sum()), np.uint64)
    filled = np.concatenate([values, np.zeros(PAYLOAD, np.uint64)])
    for s in np.unique(chosen).tolist():
        mine = chosen == s
        if s < 0:
            words[place[mine]] = ESCAPE
            words[place[mine] + 1] = values[start[mine]]
            continue
        count, bits = SELECTORS[s]
        word = np.full(int(mine.sum()), s, np.uint64)
        for k in range(count):
            word |= filled[start[mine] + k] << np.uint64(4 + k * bits)
        words[place[mine]] = word
    return words


def decode(words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` integers of ``words``."""
    selector = (words & np.uint64(15)).astype(np.int8)
    raw = np.zeros(len(words), bool)
    for k in np.flatnonzero(selector == ESCAPE).tolist():  # in order: what follows an escape is no selector
        if not raw[k]:
            raw[k + 1] = True
    heads = np.flatnonzero(~raw)
    selector = selector[heads]
    counts = np.ones(16, np.int64)
    counts[:len(SELECTORS)] = [c for c, _ in SELECTORS]
    held = counts[selector]
    place = np.cumsum(held) - held
    out = np.empty(int(held.sum()), np.uint64)
    for s in np.unique(selector).tolist():
        mine = selector == s
        if s == ESCAPE:
            out[place[mine]] = words[heads[mine] + 1]
            continue
        count, bits = SELECTORS[s]
        payload, mask = words[heads[mine]] >> _FOUR, np.uint64((1 << bits) - 1)
        for k in range(count):
            out[place[mine] + k] = (payload >> np.uint64(k * bits)) & mask
    return out[:n]
