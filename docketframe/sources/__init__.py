"""Where pages, configuration and progress come from, and where rows go."""
