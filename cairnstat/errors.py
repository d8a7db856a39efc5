"""Errors with the return codes that users of the command line know."""

from __future__ import annotations


class EngineError(ValueError):
    """``code``: 4 data would be lost, 111 not found or not numeric, 198 bad argument, 459 version, 601 no file, 602 file exists."""

    def __init__(self, code: int, message: str):
        super().__init__(f"{message} (r({code}))")
        self.code = code


class UnsupportedExpression(EngineError):
    def __init__(self, text: str):
        super().__init__(198, f"Unsupported if expression: {text}")


def require(condition: bool, code: int, message: str) -> None:
    if not condition:
        raise EngineError(code, message)
