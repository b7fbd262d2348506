"""File streams into the raw tables and incremental cell maintenance."""
