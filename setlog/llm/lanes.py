"""Automata over many texts at once.

Texts are cut into blocks that run side by side, one numpy step per position, so the cost of
a step is shared and a long text needs no more steps than a short one.
"""

from collections.abc import Iterator

import numpy as np

BLOCK = 512
#: Symbols worked on together, at most (or one text, if longer).
SYMBOLS_AT_ONCE = 4_000_000


def groups(texts: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(index of the first, texts) of runs that hold ``SYMBOLS_AT_ONCE``."""
    first, held, run = 0, 0, []
    for k, x in enumerate(texts):
        if run and held + len(x) > SYMBOLS_AT_ONCE:
            yield first, run
            first, held, run = k, 0, []
        run.append(x)
        held += len(x)
    if run:
        yield first, run


def blocks(texts: list[np.ndarray], pad: int, lead: int = 0) -> tuple[np.ndarray, ...]:
    """Steps x lanes of symbols; the text, the begin in all texts' symbols and the length
    (with its lead) of each lane.

    Every text comes with ``lead`` symbols in front; a lane begins with the ``lead`` symbols
    before its block. Lanes run from the longest to the shortest.
    """
    sizes = np.array([len(x) - lead for x in texts])
    counts = np.maximum(-(-sizes // BLOCK), 0)
    owner = np.repeat(np.arange(len(texts)), counts)
    offset = (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)) * BLOCK
    length = np.minimum(sizes[owner] - offset, BLOCK) + lead
    order = np.argsort(-length, kind="stable")
    owner, offset, length = owner[order], offset[order], length[order]
    flat = np.concatenate([*texts, np.full(BLOCK + lead, pad, texts[0].dtype)]) if texts else np.zeros(0)
    begin = np.concatenate([[0], np.cumsum([len(x) for x in texts])])[owner] + offset
    steps = int(length[0]) if len(length) else 0
    matrix = np.empty((steps, len(begin)), flat.dtype)
    for t in range(steps):
        matrix[t] = flat[begin + t]
    return matrix, owner, begin, length


def active(length: np.ndarray, steps: int) -> np.ndarray:
    """Lanes still running at each step."""
    return np.searchsorted(-length, -np.arange(steps), side="left")
