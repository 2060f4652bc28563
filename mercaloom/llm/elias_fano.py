"""Elias-Fano sequences in numpy: sorted whole numbers in little more than 2 + log2(range / count) bits each.

The low bits of every number are packed side by side; the high parts are a row of bits in which the i-th one stands at
its high part plus i. Every SAMPLE-th number is kept as it is, so a search opens only the runs it falls into.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
SAMPLE = 1 << 14


class EliasFano:
    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray, places: np.ndarray):
        self.count, self.low_bits = count, low_bits
        self.low, self.high, self.samples, self.places = low, high, samples, places

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """From whole numbers in ascending order, equal ones allowed."""
        values = values.astype(U64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(1, n)).bit_length() - 1)
        fields = ((values[:, None] >> np.arange(bits, dtype=U64)) & U64(1)).astype(np.uint8) if bits else np.zeros((n, 0), np.uint8)
        # rows of a sampled run start at a whole byte, as SAMPLE is a multiple of 8
        low = np.packbits(fields.ravel(), bitorder="little")
        place = (values >> U64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros((int(place[-1]) + 1 if n else 0), np.uint8)
        flags[place] = 1
        return cls(n, bits, low, np.packbits(flags, bitorder="little"), values[::SAMPLE].copy(), place[::SAMPLE].copy())

    def run(self, number: int) -> np.ndarray:
        """The numbers of one sampled run."""
        start, stop = number * SAMPLE, min(self.count, (number + 1) * SAMPLE)
        n = stop - start
        first = int(self.places[number])
        last = int(self.places[number + 1]) if number + 1 < len(self.places) else len(self.high) * 8
        bits = np.unpackbits(self.high[first // 8 : -(-last // 8)], bitorder="little")
        place = np.flatnonzero(bits[first % 8 :])[:n] + first
        out = (place - np.arange(start, stop)).astype(U64) << U64(self.low_bits)
        if self.low_bits:
            a = start * self.low_bits // 8
            fields = np.unpackbits(self.low[a : a + -(-n * self.low_bits // 8)], bitorder="little")[: n * self.low_bits]
            weights = U64(1) << np.arange(self.low_bits, dtype=U64)
            out |= (fields.reshape(n, self.low_bits) * weights).sum(1, dtype=U64)
        return out

    def decode(self) -> np.ndarray:
        return np.concatenate([self.run(i) for i in range(len(self.samples))] or [np.zeros(0, U64)])

    def successor(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query the index of the first number not below it, and whether it equals the query."""
        queries = queries.astype(U64)
        index, equal = np.full(len(queries), self.count, np.int64), np.zeros(len(queries), bool)
        if not self.count or not len(queries):
            return index, equal
        # the first of equal numbers may stand in the run before
        run = np.maximum(np.searchsorted(self.samples, queries, side="left") - 1, 0)
        order = np.argsort(run, kind="stable")
        edges = np.flatnonzero(np.r_[True, np.diff(run[order]) > 0, True])
        for a, b in zip(edges, edges[1:]):
            own = order[a:b]
            number = int(run[own[0]])
            values = self.run(number)
            at = np.searchsorted(values, queries[own])
            inside = at < len(values)
            index[own] = number * SAMPLE + at
            equal[own[inside]] = values[at[inside]] == queries[own[inside]]
            beyond = ~inside & (number + 1 < len(self.samples))
            if beyond.any():
                equal[own[beyond]] = self.samples[number + 1] == queries[own[beyond]]
        return index, equal

    def arrays(self) -> dict[str, np.ndarray]:
        shape = np.array([self.count, self.low_bits], np.int64)
        return {"shape": shape, "low": self.low, "high": self.high, "samples": self.samples, "places": self.places}

    @classmethod
    def from_arrays(cls, a: dict[str, np.ndarray]) -> EliasFano:
        return cls(int(a["shape"][0]), int(a["shape"][1]), a["low"], a["high"], a["samples"], a["places"])
