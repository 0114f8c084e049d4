"""Where tables, texts and streams come from and go to."""
