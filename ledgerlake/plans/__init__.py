"""Result plans: bronze, silver, gold / windows, SQL forms, quality."""
