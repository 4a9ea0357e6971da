"""Sparse matrices in compressed rows, with Gustavson's row-by-row product in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EXPANDED = 1 << 20  # products of single entries held at once


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start, as many as its count, one after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


@dataclass(frozen=True)
class Csr:
    """Row r has the columns ``indices[indptr[r]:indptr[r + 1]]`` with the values ``data`` there."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    n_columns: int

    @property
    def n_rows(self) -> int:
        return len(self.indptr) - 1

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(self.n_rows), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        counts = np.bincount(self.indices, minlength=self.n_columns)
        return Csr(np.concatenate([[0], np.cumsum(counts)]), self.rows()[order], self.data[order],
                   self.n_rows)


def incidence(lengths: np.ndarray) -> Csr:
    """Rows that cover consecutive columns, ``lengths`` of them each."""
    indptr = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    n = int(indptr[-1])
    return Csr(indptr, np.arange(n), np.ones(n, np.int64), n)


def membership(columns: np.ndarray, n_columns: int) -> Csr:
    """Rows with a single one, in the given columns."""
    n = len(columns)
    return Csr(np.arange(n + 1), columns, np.ones(n, np.int64), n_columns)


def product(a: Csr, b: Csr) -> Csr:
    """``a`` times ``b``: each row of the result is the sum of the rows of ``b`` that the row of ``a`` names.

    Rows of ``a`` are taken together as long as they name no more than ``EXPANDED`` entries of ``b``; entries
    of one place are then next to each other after a sort and are added.
    """
    width = np.diff(b.indptr)[a.indices]  # entries of b that each entry of a names
    named = np.concatenate([[0], np.cumsum(width)])[a.indptr]
    indptr, indices, data = [np.zeros(1, np.int64)], [], []
    row = 0
    while row < a.n_rows:
        end = max(row + 1, int(np.searchsorted(named, named[row] + EXPANDED, "right")) - 1)
        lo, hi = a.indptr[row], a.indptr[end]
        w = width[lo:hi]
        at = ranges(b.indptr[a.indices[lo:hi]], w)
        rows = np.repeat(np.repeat(np.arange(end - row), np.diff(a.indptr[row:end + 1])), w)
        key = rows * b.n_columns + b.indices[at]
        value = np.repeat(a.data[lo:hi], w) * b.data[at]
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        first = np.flatnonzero(np.diff(key, prepend=-1)) if len(key) else np.empty(0, np.int64)
        indices.append(key[first] % b.n_columns)
        data.append(np.add.reduceat(value, first) if len(first) else value)
        counts = np.bincount(key[first] // b.n_columns, minlength=end - row)
        indptr.append(indptr[-1][-1] + np.cumsum(counts))
        row = end
    none = np.empty(0, np.int64)
    return Csr(np.concatenate(indptr), np.concatenate([none, *indices]), np.concatenate([none, *data]),
               b.n_columns)
