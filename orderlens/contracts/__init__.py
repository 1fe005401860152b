"""Contracts shipped with the package, read from its own files on the driver."""

from importlib import resources

from orderlens.sources.contract import contract_from_text


def packaged(name):
    """Text of a packaged file."""
    return resources.files(__name__).joinpath(name).read_text(encoding="utf-8")


def packaged_contract(name):
    return contract_from_text(packaged(f"{name}.json"))
