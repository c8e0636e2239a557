"""Scratch folders, by the name under which the writers' users know them."""

from asterloom.scratch import CHECKPOINT_DIR, new_scratch_dir

__all__ = ["CHECKPOINT_DIR", "new_scratch_dir"]
