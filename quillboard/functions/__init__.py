"""Functions of the score board and the forecast scorer."""
