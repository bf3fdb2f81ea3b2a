"""Where documents come from and where they are stored."""
