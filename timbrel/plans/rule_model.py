"""A rule in place of a model, so that annotated results can be replayed in SQL."""

from __future__ import annotations

import hashlib

import numpy as np

REFUSED = 7  # texts of such a length (mod 13) are refused, which fails their batch


def layer_answers(texts: list[str]) -> list[str]:
    """One answer per text; the whole text is read."""
    return [_layer_answer(t) for t in texts]


def _layer_answer(text: str) -> str:
    if len(text) % 13 == REFUSED:
        raise ValueError(f"cannot label {len(text)} characters")
    n = text.count("the")
    kind = len(text) % 4
    if kind == 0:
        return f'{{"background": ["the {n}"], "middle_ground": [], "foreground": ["piano"]}}'
    if kind == 1:
        return f'I hear:\n{{"background": ["pad", "the {n}"], "foreground": ["pad"]}}\nend'
    if kind == 2:
        return f'{{"background": ["the {n}"'
    return f"nothing but {n}"


def plan_answers(texts: list[str]) -> list[str]:
    return [f"{t.count('the')} {{times}} in {len(t)}" for t in texts]


def sample_counts(waveforms: list[bytes]) -> list[str]:
    return [f"{len(w) // 4} samples" for w in waveforms]


def list_answers(texts: list[str]) -> list[str]:
    """A bracketed list, or the bare item; some texts are refused."""
    out = []
    for t in texts:
        if len(t) % 13 == REFUSED:
            raise ValueError(f"cannot label {len(t)} characters")
        out.append(f"I hear ['the {t.count('the')}', 'drums']." if len(t) % 3 else f" {t.count('the')} drums ")
    return out


def _heard(chat: list[dict]) -> tuple[str, str, str]:
    """What the samples of a chat come to, its system text, and the user's text."""
    system, user = chat
    parts = {p["type"]: p for p in user["content"]}
    wave = np.frombuffer(parts["audio"]["audio"], dtype="<f4").astype(float) * 32768
    text = parts["text"]["text"] if "text" in parts else ""
    return f"{len(wave)} samples of {round(wave.sum())}", system["content"][0]["text"], text


def chat_plans(chats: list[list[dict]]) -> list[str]:
    return [f"{sound} for {hashlib.md5(system.encode()).hexdigest()}" for sound, system, _ in map(_heard, chats)]


def chat_finals(chats: list[list[dict]]) -> list[str]:
    """The samples, and the digest of all that is said to the model."""
    return [
        f'{{"background": ["{sound}"], "foreground": ["{hashlib.md5((system + text).encode()).hexdigest()}"]}}'
        for sound, system, text in map(_heard, chats)
    ]


def final_answers(prompts: list[str]) -> list[str]:
    """Length and digest of the whole prompt."""
    return [f'{{"background": ["{len(p)}"], "foreground": ["{hashlib.md5(p.encode()).hexdigest()}"]}}' for p in prompts]


def timeline_answers(prompts: list[str]) -> list[str]:
    return [
        f'{{"instruments": [{{"name": "pad", "layer": "background", "timestamps": [{{"start": "0:{len(p) % 60:02d}"}}]}}]}}'
        if len(p) % 2
        else "none"
        for p in prompts
    ]


def run_answers(pairs: list[tuple[str, int]]) -> list[str]:
    """Answers that differ per ensemble run; run 1 fails on some texts."""
    out = []
    for text, run in pairs:
        if run == 1 and len(text) % 5 == 0:
            raise ValueError("run refused")
        out.append(f"run: ['i{(text.count('the') + run) % 3}', 'drums']")
    return out
