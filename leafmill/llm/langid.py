"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text in windows of bytes from both sides and labels every position; a
document gets the mean of its positions' probabilities. It is trained in numpy by
backpropagation through time, on the driver, on a bounded sample of labelled rows.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from leafmill.llm.common import LOWER, annotate, crc_mod, hashed_sample

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")

# Bounds of the training sample: so many documents, so many windows of each, of so many characters.
SAMPLE_DOCS, SAMPLE_WINDOWS, SAMPLE_CHARS = 4_000, 4, 96

HIDDEN, WINDOW, LANES = 8, 128, 1024
STEPS, BATCH, RATE = 400, 192, 0.02
SPACE = 32


def _squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|): saturates like tanh at a fraction of its cost; its slope is (1 - |result|) ** 2."""
    return x / (np.abs(x) + np.float32(1))


def _slope(squashed: np.ndarray) -> np.ndarray:
    return np.square(np.float32(1) - np.abs(squashed))


class ByteGru:
    """Weights of both directions, stacked on the first axis, and of the output layer.

    Arrays are laid out by feature, then by lane (a window of text that is read along with others).
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.languages = languages
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        self.weights = {
            "x": draw(2, 256, 3 * hidden, scale=0.5),
            "h": draw(2, 3 * hidden, hidden, scale=hidden**-0.5),
            "b": np.zeros((2, 1, 3 * hidden), dtype=np.float32),
            "o": draw(len(languages), 2 * hidden, scale=2 * hidden**-0.5),
            "c": np.zeros((len(languages), 1), dtype=np.float32),
        }

    def states(self, codes: np.ndarray, trace: list | None = None) -> np.ndarray:
        """Hidden states ``(places, 2 * hidden, lanes)`` of ``codes`` (places, lanes); the second half read backwards."""
        w = self.weights
        k, (places, lanes) = w["h"].shape[2], codes.shape
        rows = (w["x"] + w["b"]).reshape(512, 3 * k)
        both = np.stack([codes.astype(np.int64), codes[::-1].astype(np.int64) + 256], axis=1)
        h = np.zeros((2, k, lanes), dtype=np.float32)
        out = np.empty((places, 2 * k, lanes), dtype=np.float32)
        for t in range(places):
            x = np.ascontiguousarray(rows.take(both[t], axis=0).transpose(0, 2, 1))
            u = w["h"] @ h
            gates = _squash(x[:, : 2 * k] + u[:, : 2 * k])
            gates += np.float32(1)
            gates *= np.float32(0.5)
            z, r = gates[:, :k], gates[:, k:]
            n = _squash(x[:, 2 * k :] + r * u[:, 2 * k :])
            if trace is not None:
                trace.append((h, u[:, 2 * k :], z, r, n))
            h = n + z * (h - n)
            out[t, :k], out[places - 1 - t, k:] = h
        return out

    def probabilities(self, states: np.ndarray) -> np.ndarray:
        """Of every language at every place, ``(places, languages, lanes)``."""
        logits = self.weights["o"] @ states + self.weights["c"]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def gradients(self, codes: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all places, and its gradients by backpropagation through time."""
        w = self.weights
        k, (places, lanes) = w["h"].shape[2], codes.shape
        trace: list = []
        states = self.states(codes, trace)
        d = self.probabilities(states)
        total = max(1.0, float(mask.sum()))
        own = np.arange(lanes)
        loss = -float((mask * np.log(d[:, labels, own] + 1e-9)).sum()) / total
        d[:, labels, own] -= 1
        d *= (mask / np.float32(total))[:, None, :]
        grad = {name: np.zeros_like(v) for name, v in w.items()}
        grad["o"], grad["c"] = np.einsum("tln,tkn->lk", d, states), d.sum(axis=(0, 2))[:, None]
        back = w["o"].T @ d
        dh = np.zeros((2, k, lanes), dtype=np.float32)
        for t in reversed(range(places)):
            h, un, z, r, n = trace[t]
            dh = dh + np.stack([back[t, :k], back[places - 1 - t, k:]])
            dn = dh * (1 - z) * _slope(n)
            dz = dh * (h - n) * (0.5 * _slope(2 * z - 1))
            dr = dn * un * (0.5 * _slope(2 * r - 1))
            dx = np.concatenate([dz, dr, dn], axis=1).transpose(0, 2, 1)
            du = np.concatenate([dz, dr, dn * r], axis=1)
            grad["h"] += du @ h.transpose(0, 2, 1)
            grad["b"] += dx.sum(axis=1, keepdims=True)
            for side, place in ((0, t), (1, places - 1 - t)):
                np.add.at(grad["x"][side], codes[place], dx[side])
            dh = dh * z + w["h"].transpose(0, 2, 1) @ du
        return loss, grad

    def train(self, codes: np.ndarray, mask: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 1) -> ByteGru:
        """Adam over random batches of windows ``(windows, places)``; languages are drawn alike often."""
        rng = np.random.default_rng(seed)
        share = 1 / np.bincount(labels, minlength=len(self.languages))[labels]
        share /= share.sum()
        mean = {n: np.zeros_like(v) for n, v in self.weights.items()}
        square = {n: np.zeros_like(v) for n, v in self.weights.items()}
        for step in range(1, steps + 1):
            chosen = rng.choice(len(labels), BATCH, p=share)
            # Half of the windows are cut short, as short texts are.
            length = np.where(rng.random(BATCH) < 0.5, codes.shape[1], rng.integers(4, 4 + codes.shape[1], BATCH))
            real = np.arange(codes.shape[1]) < length[:, None]
            cut = np.where(real, codes[chosen], np.uint8(SPACE))
            _, grad = self.gradients(cut.T, (mask[chosen] * real).T, labels[chosen])
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for name, g in grad.items():
                mean[name] += 0.1 * (g - mean[name])
                square[name] += 0.01 * (g * g - square[name])
                ahead = mean[name] / (1 - 0.9**step)
                self.weights[name] -= rate * ahead / (np.sqrt(square[name] / (1 - 0.99**step)) + 1e-7)
        return self

    def document_probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Mean over all positions of each whole text, ``(texts, languages)``; zeros for an empty one."""
        total = np.zeros((len(texts), len(self.languages)))
        counts = [-(-len(t) // WINDOW) for t in texts]
        owner = np.repeat(np.arange(len(texts)), counts)
        begins = np.concatenate([np.arange(c) for c in counts]) * WINDOW if counts else owner
        for start in range(0, len(owner), LANES):
            whose, places = owner[start : start + LANES], begins[start : start + LANES]
            parts = [texts[i][b : b + WINDOW] for i, b in zip(whose, places, strict=True)]
            codes, mask = window_codes(parts, max(map(len, parts)))
            p = self.probabilities(self.states(codes.T))
            np.add.at(total, whose, np.einsum("tln,nt->nl", p, mask))
        return total / np.maximum(1, [[len(t)] for t in texts]) if len(texts) else total


def window_codes(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes ``(parts, width)`` padded by spaces, and 1 where they are real."""
    codes = np.frombuffer(b"".join(p.ljust(width) for p in parts), dtype=np.uint8).reshape(len(parts), width)
    lengths = np.array([len(p) for p in parts])
    return LOWER[codes], (np.arange(width) < lengths[:, None]).astype(np.float32)


def train(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> ByteGru | None:
    """A network from labelled rows; None if no row has a language and a letter.

    Learns from the ``SAMPLE_DOCS`` rows that come first by a hash of the id, and of each from
    ``SAMPLE_WINDOWS`` windows spread evenly over its whole text.
    """
    body = F.col(text)
    step = F.greatest(F.lit(1), F.floor((F.length(body) - SAMPLE_CHARS) / (SAMPLE_WINDOWS - 1)))
    windows = [F.substr(body, (F.lit(i) * step + 1).cast("int"), F.lit(SAMPLE_CHARS)) for i in range(SAMPLE_WINDOWS)]
    labelled = documents.filter(F.col(lang).isNotNull() & body.isNotNull())
    labelled = labelled.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.array(*windows).alias("windows"))
    sample = [r for r in hashed_sample(labelled, "id", SAMPLE_DOCS).collect() if any(part and LETTER.search(part) for part in r["windows"])]
    if not sample:
        return None
    sample.sort(key=lambda r: (r["id"] is None, r["id"], r["lang"], r["windows"]))
    languages = sorted({r["lang"] for r in sample})
    pairs = [(part.encode(), languages.index(r["lang"])) for r in sample for part in dict.fromkeys(r["windows"]) if part]
    codes, mask = window_codes([p[:SAMPLE_CHARS] for p, _ in pairs], SAMPLE_CHARS)
    return ByteGru(languages).train(codes, mask, np.array([label for _, label in pairs]))


SCORED = "lang_pred string, lang_score double"


def scorer(model: ByteGru | None):
    def score(texts: list[bytes]) -> list:
        has_letter = [bool(LETTER.search(t.decode("utf-8", "replace"))) for t in texts]
        if model is None:
            return [[UNKNOWN] * len(texts), [0.0] * len(texts)]
        p = model.document_probabilities(texts)
        best = p.argmax(axis=1)
        names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter, strict=True)]
        return [names, np.where(has_letter, np.clip(p[np.arange(len(texts)), best], 0, 1), 0.0)]

    return score


def predict(documents: DataFrame, model: ByteGru | None, carry: list[str], text: str = "text") -> DataFrame:
    """``row`` (the carried columns), ``lang_pred``, ``lang_score`` for every row, whole texts.

    A null or empty text and one without a letter is ``und`` with score 0, as is every text when
    there was nothing to learn from. Repeated rows are scored each; no rows: no rows.
    """
    return annotate(documents, text, carry, SCORED, lambda: scorer(model))


def identify(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: learns from rows whose crc32 of the id is no multiple of 5."""
    model = train(documents.filter(crc_mod(F.col(doc_id), 5) != 0), doc_id, text, lang)
    found = predict(documents, model, [doc_id], text)
    key = F.col(f"row.{doc_id}")
    held_out = F.coalesce(crc_mod(key, 5) == 0, F.lit(False))
    return found.select(key.alias("doc_id"), held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
