"""Pieces and scores of an existing sentencepiece vocabulary, read once on the driver."""

from dataclasses import dataclass

MARK = "▁"  # stands for a blank
UNKNOWN = -10.0  # an unknown character scores this much below the lowest piece


def default_path():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class Vocabulary:
    """Normal pieces with their scores; ``byte_fallback``: an unknown character becomes its bytes."""

    pieces: tuple
    scores: tuple
    byte_fallback: bool

    @property
    def unknown(self):
        return min(self.scores) + UNKNOWN


def load(path=None):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=str(path or default_path()))
    kept, byte = [], False
    for i in range(model.vocab_size()):
        byte |= model.is_byte(i)
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            kept.append((model.id_to_piece(i), model.get_score(i)))
    return Vocabulary(tuple(p for p, _ in kept), tuple(s for _, s in kept), byte)
