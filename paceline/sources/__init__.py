"""Where data comes from and where batch tables go."""
