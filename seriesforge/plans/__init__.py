"""Named plans over the shared tables, training and the end-to-end flow."""
