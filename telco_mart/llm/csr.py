"""Sparse matrices in compressed rows and their row-wise product."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Csr:
    """Row i has the columns indices[indptr[i]:indptr[i + 1]], ascending, with
    the values at the same places of ``data``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    width: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1


def spans(ends: np.ndarray) -> Csr:
    """Incidence of consecutive spans that cover 0..ends[-1]: row i has a one in
    each place from the end of span i - 1 to its own."""
    width = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]).astype(np.int64), np.arange(width), np.ones(width, dtype=np.int64), width)


def membership(group: np.ndarray, groups: int) -> Csr:
    """Incidence of items and groups: row i has a one in column group[i]."""
    return Csr(np.arange(len(group) + 1), group.astype(np.int64), np.ones(len(group), dtype=np.int64), groups)


def transposed(m: Csr) -> Csr:
    row = np.repeat(np.arange(m.rows), np.diff(m.indptr))
    sorted_ = (m.indices[1:] >= m.indices[:-1]).all()
    order = slice(None) if sorted_ else np.argsort(m.indices, kind="stable")
    counts = np.bincount(m.indices, minlength=m.width)
    return Csr(np.concatenate([[0], np.cumsum(counts)]), row[order], m.data[order], m.rows)


def row_terms(a: Csr, b: Csr) -> np.ndarray:
    """Terms of each row of A B before equal columns are added: the sizes of the
    rows of B that the row of A selects."""
    each = np.diff(b.indptr)[a.indices]
    upto = np.concatenate([[0], np.cumsum(each)])
    return upto[a.indptr[1:]] - upto[a.indptr[:-1]]


def products(a: Csr, b: Csr, terms: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, columns, values) of A B in blocks of whole rows, by Gustavson's
    rule: row i of the product is the sum of the rows of B that row i of A
    selects, each times its value. A block has about ``terms`` terms, so memory
    is bounded however many entries the product has; a row of more terms is a
    block of its own."""
    size = row_terms(a, b)
    upto = np.concatenate([[0], np.cumsum(size)])
    lo = 0
    while lo < a.rows:
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + terms, side="right")) - 1)
        first, last = a.indptr[lo], a.indptr[hi]
        picked, value = a.indices[first:last], a.data[first:last]
        row = np.repeat(np.arange(lo, hi), np.diff(a.indptr[lo:hi + 1]))
        n = b.indptr[picked + 1] - b.indptr[picked]
        ahead = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(b.indptr[picked] - ahead, n)
        key = np.repeat(row, n) * b.width + b.indices[at]
        term = np.repeat(value, n) * b.data[at]
        if len(key):
            if (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")
                key, term = key[order], term[order]
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            yield key[start] // b.width, key[start] % b.width, np.add.reduceat(term, start)
        lo = hi
