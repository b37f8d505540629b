"""Ready-made plans: from raw tables through facts and dimensions to dashboard blocks."""
