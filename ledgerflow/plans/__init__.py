"""Named queries, views and scripts."""
