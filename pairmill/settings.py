"""Tunable numbers of the library, in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass

PAD, SOS, EOS, UNK = 0, 1, 2, 3
SPECIAL_TOKENS = ("<pad>", "<sos>", "<eos>", "<unk>")


@dataclass(frozen=True)
class Settings:
    """Defaults used by every plan; override with ``dataclasses.replace``."""

    max_src_len: int = 32          # query ids, <sos>/<eos> included
    max_tgt_len: int = 120         # reply ids, <sos>/<eos> included
    min_freq: int = 2              # vocabulary threshold
    slot_min_freq: int = 20        # rarer slots share the generic one
    scope_min_freq: int = 2
    anchor_top_k: int = 200
    min_query_words: int = 2
    min_reply_words: int = 3
    replies_per_query: int = 4
    split_ratios: tuple[float, float, float] = (0.8, 0.1, 0.1)
    seed: int = 42
    batch_size: int = 64
    length_penalty: float = 0.7
    no_repeat_ngram: int = 3
    max_oov: float = 0.50          # inclusive
    min_logprob: float = -1.50     # inclusive
    lm_weight: float = 0.7         # bigram share of the interpolated model

    # Size bounds that decide between an in-plan dictionary and a shuffled join.
    literal_entries: int = 1_000
    broadcast_rows: int = 500_000
    broadcast_bytes: int = 64 << 20
    hot_keys: int = 2_000
    hot_min_rows: int = 100_000

    @property
    def max_query_words(self) -> int:
        return self.max_src_len - 2

    @property
    def reply_budget(self) -> int:
        return self.max_tgt_len - 2
