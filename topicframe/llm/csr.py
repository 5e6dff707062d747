"""Sparse integer matrices in compressed rows, and their products by rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (lengths[0] of them), then starts[1], ..."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


@dataclass
class Csr:
    """Row i has ``values[indptr[i]:indptr[i + 1]]`` in the columns ``indices[indptr[i]:indptr[i + 1]]``."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    n_columns: int

    @classmethod
    def of(cls, rows: np.ndarray, columns: np.ndarray, n_rows: int, n_columns: int, values: np.ndarray | None = None) -> Csr:
        """From places in any order; values of one place are added up. Without values each counts 1."""
        values = np.ones(len(rows), np.int64) if values is None else values
        place = rows.astype(np.int64) * max(n_columns, 1) + columns
        if len(place) and not (place[1:] > place[:-1]).all():
            place, at = np.unique(place, return_inverse=True)
            values = np.bincount(at, values, len(place)).astype(np.int64)
        rows, columns = np.divmod(place, max(n_columns, 1))
        return cls(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n_rows))]), columns, values, n_columns)

    @property
    def n_rows(self) -> int:
        return len(self.indptr) - 1

    def rows(self) -> np.ndarray:
        """The row of each stored place."""
        return np.repeat(np.arange(self.n_rows), np.diff(self.indptr))

    def transposed(self) -> Csr:
        return Csr.of(self.indices, self.rows(), self.n_columns, self.n_rows, self.values)

    def __matmul__(self, other: Csr) -> Csr:
        """Product by rows: row i is the sum of other's rows k, weighted by the values (i, k) of this one."""
        lengths = np.diff(other.indptr)[self.indices]
        taken = spread(other.indptr[self.indices], lengths)
        return Csr.of(
            np.repeat(self.rows(), lengths), other.indices[taken], self.n_rows, other.n_columns,
            np.repeat(self.values, lengths) * other.values[taken],
        )
