"""Errors of reading, checking and publishing a corpus.

Fixed values: the messages, which callers see and match.
"""

from __future__ import annotations


class CorpusError(Exception):
    """Base of all errors below."""


class ReadError(CorpusError):
    def __init__(self, path, cause):
        super().__init__(f"failed to read {path}: {cause}")
        self.path, self.cause = path, cause


class WriteError(CorpusError):
    def __init__(self, path, cause):
        super().__init__(f"failed to write {path}: {cause}")
        self.path, self.cause = path, cause


class JsonError(CorpusError):
    def __init__(self, path, cause):
        super().__init__(f"invalid JSON in {path}: {cause}")
        self.path, self.cause = path, cause


class InvalidConfig(CorpusError):
    def __init__(self, what):
        super().__init__(f"invalid pipeline configuration: {what}")


class InvalidManifest(CorpusError):
    def __init__(self, what):
        super().__init__(f"invalid source manifest: {what}")


class SizeMismatch(CorpusError):
    def __init__(self, path, expected, actual):
        super().__init__(f"byte size mismatch for {path}: expected {expected}, got {actual}")
        self.path, self.expected, self.actual = path, expected, actual


class ChecksumMismatch(CorpusError):
    def __init__(self, path, expected, actual):
        super().__init__(f"checksum mismatch for {path}: expected {expected}, got {actual}")
        self.path, self.expected, self.actual = path, expected, actual


class CommandError(CorpusError):
    def __init__(self, command, status, stderr):
        super().__init__(f"command {command} failed with status {status}: {stderr}")
        self.command, self.status, self.stderr = command, status, stderr


class ToolOutputError(CorpusError):
    def __init__(self, field):
        super().__init__(f"could not parse {field} from tool output")
        self.field = field


class InvalidExtraction(CorpusError):
    def __init__(self, what):
        super().__init__(f"invalid extraction output: {what}")
