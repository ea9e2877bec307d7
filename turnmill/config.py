"""Parameters of the jobs, with the defaults users of the reference know."""

from dataclasses import dataclass


@dataclass(frozen=True)
class PrepareConfig:
    """Settings of the prepare job."""

    out: str = "./outputs/datasets"
    train_split: float = 0.97
    min_length: int = 10
    max_length: int = 8000
    seed: int = 42
    preview: int = 5


@dataclass(frozen=True)
class GenerationParams:
    """Sampling settings recorded with every evaluation result."""

    max_new_tokens: int = 256
    temperature: float = 0.7
    top_p: float = 0.9


@dataclass(frozen=True)
class ChatTemplate:
    """The fixed strings around the turns of a rendered chat.

    A turn renders as ``role_prefix + role + role_suffix + content + turn_end``;
    turns are joined by ``separator`` and preceded by ``bos``.  When a generation
    prompt is asked for, ``generation_prefix`` follows the last turn.
    """

    bos: str = ""
    role_prefix: str = ""
    role_suffix: str = ": "
    turn_end: str = ""
    separator: str = ""
    generation_prefix: str = ""
    capitalize_roles: bool = False


PLAIN = ChatTemplate(separator="\n", capitalize_roles=True)

CHATML = ChatTemplate(
    role_prefix="<|im_start|>",
    role_suffix="\n",
    turn_end="<|im_end|>\n",
    generation_prefix="<|im_start|>assistant\n",
)
