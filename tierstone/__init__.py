"""Layered (bronze, silver, gold) analytics as plain PySpark DataFrame functions."""

from tierstone.contracts import TableContract, contract
from tierstone.session import prepare, scratch_dir

__all__ = ["TableContract", "contract", "prepare", "scratch_dir"]
