"""Errors a caller can act on."""


class ContractError(ValueError):
    """A contract definition cannot be used."""


class InputError(ValueError):
    """Input lines cannot be read as records."""


class EnforcementError(RuntimeError):
    """Data did not meet its contract."""
