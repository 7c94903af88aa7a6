"""Frozen run configurations. Defaults are the reference's constants."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LengthGate:
    min_total: int
    max_total: int
    min_target: int
    max_target: int


@dataclass(frozen=True)
class Bucket:
    name: str
    min_total: int
    max_total: int
    target: int


@dataclass(frozen=True)
class SetConfig:
    """SFT + calibration selection settings of one dataset generation."""

    seed: int
    n_sft: int
    n_calib: int
    sft_gate: LengthGate
    calib_gate: LengthGate
    buckets: tuple[Bucket, ...]
    max_messages: int = 12
    # characters of each text that enter record ids and dedup keys (None: the whole text)
    id_chars: int | None = None
    key_chars: int | None = None

    def __post_init__(self):
        total = sum(b.target for b in self.buckets)
        if total != self.n_calib:
            raise ValueError(f"bucket targets sum to {total}, need n_calib={self.n_calib}")

    def with_quotas(self, n_sft: int, bucket_targets: dict[str, int]) -> "SetConfig":
        bs = tuple(Bucket(b.name, b.min_total, b.max_total, bucket_targets[b.name]) for b in self.buckets)
        return SetConfig(self.seed, n_sft, sum(bucket_targets.values()), self.sft_gate,
                         self.calib_gate, bs, self.max_messages, self.id_chars, self.key_chars)


# Prefix lengths for ids and keys, for sets that must match prefix-keyed ones
# (`replace(V2, **PREFIX_KEYS)`); records that differ only later then count as one.
PREFIX_KEYS = {"id_chars": 300, "key_chars": 500}
PREFIX_KD_KEYS = {"prompt_key_chars": 500, "gold_key_chars": 300}

# Selection constants of the instruction (v1) generation.
V1 = SetConfig(
    seed=0, n_sft=30_000, n_calib=1_000,
    sft_gate=LengthGate(32, 768, 8, 256),
    calib_gate=LengthGate(32, 1024, 4, 384),
    buckets=(Bucket("short", 32, 128, 300), Bucket("mid", 129, 384, 500), Bucket("long", 385, 1024, 200)),
)

# Selection constants of the chat (v2) generation.
V2 = SetConfig(
    seed=0, n_sft=30_000, n_calib=1_000,
    sft_gate=LengthGate(64, 1024, 16, 512),
    calib_gate=LengthGate(64, 1536, 8, 768),
    buckets=(Bucket("short", 64, 256, 300), Bucket("mid", 257, 768, 500), Bucket("long", 769, 1536, 200)),
    max_messages=12,
)


@dataclass(frozen=True)
class DistillConfig:
    # Distillation constants.
    seed: int = 0
    n_kd: int = 15_000
    max_prompt_tokens: int = 1024
    max_new_tokens: int = 192
    min_teacher_tokens: int = 8
    max_teacher_tokens: int = 256
    repetition_min_words: int = 8
    repetition_ratio: float = 0.35
    teacher_model: str = "teacher"
    prompt_key_chars: int | None = None
    gold_key_chars: int | None = None
    markers: tuple[str, ...] = (
        "<|start_header_id|>", "<|eot_id|>", "assistant\n", "user\n", "system\n",
        "### Instruction:", "### Response:",
    )
    stop: tuple[str, ...] = ("<|eot_id|>", "<|start_header_id|>", "### Instruction:", "### Response:")


@dataclass(frozen=True)
class TrainConfig:
    # Fine-tuning data constants.
    seed: int = 0
    max_seq_len: int = 1024
    eval_ratio: float = 0.02
    min_sup_tokens: int = 32
    batch_size: int = 1
    pad_id: int = 0


@dataclass(frozen=True)
class CalibConfig:
    # Pruning calibration constants.
    seed: int = 0
    num_samples: int = 1_000
    max_seq_len: int = 1024


# Quantisation calibration constants.
QUANT_CALIB = CalibConfig(num_samples=512, max_seq_len=2048)


@dataclass(frozen=True)
class EvalConfig:
    # Evaluation constants.
    seed: int = 0
    n_per_task: int | None = 800
    batch_size: int = 64
    top_logprobs: int = 20
    dataset_order: tuple[str, ...] = ("hellaswag", "arc_challenge", "winogrande", "truthfulqa_mc", "overall_micro")
    overall_name: str = "overall_micro"


@dataclass(frozen=True)
class SparsityConfig:
    n: int = 2
    m: int = 4
    sample_tensors: int = 8
    seed: int = 0
    # Names of the projection layers that are pruned.
    targets: tuple[str, ...] = ("q_proj", "k_proj", "v_proj", "o_proj", "gate_proj", "up_proj", "down_proj")
    ignore: tuple[str, ...] = ("lm_head",)
