"""What strict mode raises on the driver: one kind of exception, told apart by which operator gave up."""

from __future__ import annotations


class Fault(Exception):
    """Data that an operator refuses. ``reason`` is a sentence, ``about`` names what it is about;
    every entry can be read as an attribute."""

    def __init__(self, reason: str, /, **about) -> None:
        self.reason, self.about = reason, about
        listed = ", ".join(f"{name}={value!r}" for name, value in about.items())
        super().__init__(f"{reason} ({listed})" if listed else reason)

    def __getattr__(self, name: str):
        try:
            return self.__dict__["about"][name]
        except KeyError:
            raise AttributeError(name) from None


class ScanFault(Fault):
    """A planned shard or a folder is not there."""


class PairFault(Fault):
    """A subject lacks one of the modalities."""


class GuardFault(Fault):
    """Rows or columns do not have the form of their schema."""


class VersionFault(Fault):
    """Rows are of a newer version than this library reads."""


class LogFault(Fault):
    """A log line cannot be read, or a record is not what was written."""


class RunFault(Fault):
    """A run's manifest could not be stored."""


class RegistryFault(Fault):
    """A model or version is not registered."""
