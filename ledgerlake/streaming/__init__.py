"""File streams that run the batch steps on whatever has arrived."""
